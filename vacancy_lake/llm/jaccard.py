"""Near-duplicates by exact Jaccard similarity of word shingles.

Texts meet under ``BANDS`` keys, each made of ``ROWS`` MinHash values of the shingles: a pair of
similarity 0.8 shares a key with probability 1 - (1 - 0.8 ** 6) ** 24 = 0.9993, one of 0.3 with 0.017.
Texts whose SimHash fingerprints of the same shingles are linked at ``simhash.MAX_DISTANCE`` bits meet
under a further key.
Many pages of one template would be chained by such chances, so a pair that meets is a candidate only
if its signatures (a byte of each MinHash value) agree in enough places: 0.15 below the similarity
asked for is 4.5 standard deviations of the estimate at 0.8.  Candidates form groups, and a group's
texts are brought together once, where each candidate pair that could still join two parts of the
group is compared in full.  The texts of a group too large for one task are dealt into parts that
meet two by two; a group of more than ``BANDS`` parts meets by its keys instead, so that a text is
sent ``BANDS`` times at most, but for keys too large for one task, which are dealt into parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .batches import append_columns, ragged
from .components import components
from .store import written

BANDS, ROWS = 24, 6
#: Shingles of the texts of one part of a group; a task holds two parts.
PART_SHINGLES = 1_000_000
#: Places in which signatures may agree less than the similarity asked for.
MARGIN = 0.15
#: Texts of a key whose signatures are compared; those of a larger one are all linked to its first.
KEY_LIMIT = 5_000
_rng = np.random.default_rng(5)
FACTORS = _rng.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64)
LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def normal(text: bytes | None) -> bytes:
    """Words in lower case (A-Z), one space between them."""
    return b" ".join((text or b"").lower().split())


def digest(joined: bytes) -> int:
    """The number of a normal text, as a signed 64-bit integer; zero without words."""
    return int(np.uint64(xxhash.xxh64_intdigest(joined, 7)).astype(np.int64)) if joined else 0


def shingles(joined: bytes, size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words of a normal text (all its words, if fewer)."""
    if not joined:
        return np.empty(0, np.uint64)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces.tolist(), len(joined)]
    last = min(size, len(ends)) - 1
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.array([hashed(joined[a:b], 42) for a, b in zip(starts, ends[last:])], dtype=np.uint64))


def sketch(hashes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The keys of a text, MinHash values mixed by bands, and its signature; none without shingles."""
    if not len(hashes):
        return np.empty(0, np.int64), b""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1 << 10):
        values = FACTORS[:, None] * hashes[None, at : at + (1 << 10)] + OFFSETS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = (key ^ (row >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64), (least >> np.uint64(24)).astype(np.uint8).tobytes()


def crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: those whose key another row has, too."""
    held, hot = pa.table({"key": pa.array([], pa.int64()), "fp": pa.array([], pa.int64())}), False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_tables([held, pa.Table.from_batches([batch]).select(["key", "fp"]).cast(held.schema)])
        keys = rows.column("key").to_numpy()
        same = keys[1:] == keys[:-1]
        shared = np.append(same, False)
        shared[1:] |= same
        shared[0] |= hot
        held, hot = rows.slice(len(rows) - 1), bool(shared[-1])
        yield from rows.slice(0, len(rows) - 1).filter(pa.array(shared[:-1])).to_batches()
    if hot:
        yield from held.to_batches()


def signature_links(signatures: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Places of pairs that connect all rows which pairs agreeing in ``least`` of their bytes connect."""
    found = []
    rest = np.arange(len(signatures))
    while len(rest) > 1:
        border, rest = [rest[0]], rest[1:]
        while border and len(rest):
            at = border.pop()
            near = (signatures[rest] == signatures[at]).mean(axis=1) >= least
            close, rest = rest[near], rest[~near]
            found += [(int(at), int(x)) for x in close]
            border.extend(close)
    return found


def candidate_links(least: float, limit: int):
    """For rows (key, fp, signature) sorted by key: links of texts whose signatures agree enough.

    From the row after ``limit`` on, all texts of a key are linked to its first: a task holds no more
    than that many of them.
    """

    def links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def close(fps: list[int], signatures: list[bytes]) -> list[tuple[int, int]]:
        places = np.frombuffer(b"".join(signatures), np.uint8).reshape(len(fps), -1)
        return [(fps[x], fps[y]) for x, y in signature_links(places, least)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fps, held, over, found = None, [], [], False, []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "fp", "signature")), strict=True)
            for key, fp, signature in rows:
                if key != now:
                    if not over and len(fps) > 1:
                        found += close(fps, held)
                    now, fps, held, over = key, [fp], [signature], False
                elif over:
                    found.append((fp, fps[0]))
                elif len(fps) < limit:
                    fps.append(fp)
                    held.append(signature)
                else:
                    found += [(x, fps[0]) for x in [*fps[1:], fp]]
                    fps, held, over = fps[:1], [], True
            yield links(found)
            found = []
        if not over and len(fps) > 1:
            yield links(close(fps, held))

    return run


def group_links(sets: list[np.ndarray], keys: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Places of pairs that connect all texts which similar candidate pairs connect."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    begins = np.cumsum(sizes) - sizes
    mark = np.zeros(int(codes.max()) + 1, dtype=bool)
    found = []
    rest = np.arange(len(sets))
    while len(rest) > 1:
        border, rest = [rest[0]], rest[1:]
        while border and len(rest):
            at = border.pop()
            low, high = np.minimum(sizes[rest], sizes[at]), np.maximum(sizes[rest], sizes[at])
            near = np.flatnonzero(low >= similarity * high - 1e-9)
            near = near[(keys[rest[near]] == keys[at]).any(axis=1)]
            if not len(near):
                continue
            own = codes[begins[at] : begins[at] + sizes[at]]
            mark[own] = True
            reached = np.zeros(len(rest), dtype=bool)
            for k in range(0, len(near), 2000):
                part = near[k : k + 2000]
                n = sizes[rest[part]]
                shared = np.add.reduceat(mark[codes[ragged(begins[rest[part]], n)]], np.cumsum(n) - n, dtype=np.int64)
                reached[part] = shared >= similarity * (n + sizes[at] - shared) - 1e-9
            mark[own] = False
            close, rest = rest[reached], rest[~reached]
            found += [(int(at), int(x)) for x in close]
            border.extend(close)
    return found


def compare_groups(size: int, similarity: float):
    """For rows (kind, unit, part pair, fp, near, text) sorted by all but the last three: links of similar texts."""

    def links(texts: dict[int, tuple[int, bytes]]) -> pa.RecordBatch:
        fps = list(texts)
        sets = [shingles(texts[x][1], size) for x in fps]
        keys = [np.append(sketch(s)[0], texts[x][0]) for x, s in zip(fps, sets)]
        found = group_links(sets, np.array(keys), similarity) if len(fps) > 1 else []
        a, b = [fps[x] for x, _ in found], [fps[y] for _, y in found]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("kind", "unit", "x", "y", "fp", "near")), strict=True)
            texts = batch.column("normal")
            for k, (*unit, fp, near) in enumerate(places):
                if unit != now:
                    if len(held) > 1:
                        yield links(held)
                    now, held = unit, {}
                if fp not in held:
                    held[fp] = near, texts[k].as_py()
        if len(held) > 1:
            yield links(held)

    return run


def with_near_key(texts: DataFrame) -> DataFrame:
    """``texts`` with ``near``, a key of all texts whose fingerprints (column simhash) are linked, which is added to
    the keys of a text that has any."""
    texts = written(texts, "distinct")
    roots = components(simhash.fingerprint_links(texts.select(F.col("simhash").alias("fp")).distinct()))
    named = texts.join(roots.withColumnRenamed("node", "simhash"), "simhash", "left")
    near = F.xxhash64(F.lit("simhash"), F.coalesce("root", "simhash"))
    named = named.withColumn("near", near).drop("root", "simhash")
    keys = F.when(F.size("keys") > 0, F.array_append("keys", F.col("near"))).otherwise(F.col("keys"))
    return written(named.withColumn("keys", keys), "keyed")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    part_shingles: int = PART_SHINGLES,
    most_parts: int = BANDS,
    key_limit: int = KEY_LIMIT,
) -> DataFrame:
    """Per row of ``docs``: id, ``component_id``.

    Words are lower-cased (A-Z) and cut at white space.  Texts whose sets of ``shingle``-word runs
    have a Jaccard similarity of at least ``similarity`` are linked, and ``component_id`` is the
    smallest id that links reach; a text of fewer words has one run.  Null, empty and blank texts
    are linked to each other.  A null id never names a component (it does if there is no other).
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def marks(texts: list[bytes | None]) -> tuple:
        joined = [normal(x) for x in texts]
        sets = [shingles(x, shingle) for x in joined]
        keys, signatures = zip(*map(sketch, sets)) if sets else ((), ())
        return [digest(x) for x in joined], [len(s) for s in sets], keys, signatures, [simhash.fingerprint(x, shingle) for x in joined]

    fields = [
        T.StructField("fp", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("signature", T.BinaryType()),
        T.StructField("simhash", T.LongType()),
    ]
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    marked = written(append_columns(source, "__text", marks, fields, ["__id"]), "marked")
    texts = with_near_key(
        marked.groupBy("fp").agg(
            F.min("__id").alias("first_id"),
            F.first("n").alias("n"),
            F.first("keys").alias("keys"),
            F.first("signature").alias("signature"),
            F.first("simhash").alias("simhash"),
        )
    )
    meet = texts.select("fp", F.explode("keys").alias("key")).repartition(n, "key").sortWithinPartitions("key", "fp")
    met = written(meet.mapInArrow(crowded, "key long, fp long"), "met")
    candidates = (
        met.join(texts.select("fp", "signature"), "fp")
        .repartition(n, "key")
        .sortWithinPartitions("key", "fp")
        .select("key", "fp", "signature")
        .mapInArrow(candidate_links(similarity - MARGIN, key_limit), LINKS)
    )
    groups = components(candidates).withColumnRenamed("node", "fp")
    groups = written(groups.join(texts.select("fp", "n", "near"), "fp"), "groups")
    parts = F.ceil(F.sum("n") / F.lit(part_shingles)).alias("parts")
    of_group = groups.join(groups.groupBy("root").agg(parts), "root")
    whole = of_group.filter(F.col("parts") <= most_parts).select(F.lit(0).alias("kind"), F.col("root").alias("unit"), "fp", "near", "parts")
    large = met.join(of_group.filter(F.col("parts") > most_parts).select("fp", "n", "near"), "fp")
    shared = large.groupBy("key").agg(parts, F.count("*").alias("members")).filter("members > 1")
    by_key = large.join(shared, "key").select(F.lit(1).alias("kind"), F.col("key").alias("unit"), "fp", "near", "parts")
    placed = whole.unionByName(by_key).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))

    def normals(values: list[bytes | None]) -> tuple:
        joined = [normal(x) for x in values]
        return [digest(x) for x in joined], joined

    fields = [T.StructField("fp", T.LongType()), T.StructField("normal", T.BinaryType())]
    held = append_columns(source, "__text", normals, fields, []).join(placed, "fp")
    pairs = held.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    compared = (
        pairs.select("kind", "unit", F.least("part", "o").alias("x"), F.greatest("part", "o").alias("y"), "fp", "near", "normal")
        .repartition(n, "kind", "unit", "x", "y")
        .sortWithinPartitions("kind", "unit", "x", "y")
        .mapInArrow(compare_groups(shingle, similarity), LINKS)
    )
    roots = components(written(compared, "similar"))
    named = texts.select("fp", "first_id").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = named.join(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
    return marked.join(named.select("fp", "component_id"), "fp").select(F.col("__id").alias(id_col), "component_id")
