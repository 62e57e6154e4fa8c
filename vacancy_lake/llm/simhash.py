"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two segments of 32 bits.  If two fingerprints differ in at most four bits, one of
the segments differs in at most two, so the balls of radius one around the two segments meet.  Every
distinct fingerprint is put under all 33 values of the ball of each segment; fingerprints that meet
under a value are compared in full.  Values are 32 bits wide, so few others meet by chance.

Groups of thousands of near copies meet under the same values.  A task walks through the sorted
values and links only fingerprints that its own forest does not connect yet, so it never puts out
the pairs of a group.  A value with more than ``GROUP_LIMIT`` fingerprints is not compared in one
task at all: its fingerprints are put under all 2,081 values at most two bits from them instead,
and those that meet there, which lie within four bits of each other, are linked to the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import jaccard
from .batches import append_columns
from .components import components
from .store import written

BITS = 64
MAX_DISTANCE = 4
GROUP_LIMIT = 20_000


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit integer; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.array([len(w) + 1 for w in words])).tolist()
    ends = (ends - 1).tolist()
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[starts[k] : ends[k + last]], 42) for k in range(n)], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """id, fp of every row."""
    fp = T.StructField("fp", T.LongType())
    return append_columns(docs, text_col, lambda texts: ([fingerprint(x, shingle) for x in texts],), [fp], [id_col])


class Forest:
    """Union-find over the fingerprints one task has seen; forgets all when it has grown too large."""

    def __init__(self, limit: int = 500_000) -> None:
        self.parent: dict[int, int] = {}
        self.limit = limit

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        """True if the two were not connected before."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if len(self.parent) > self.limit:
            self.parent.clear()
        self.parent[max(a, b)] = min(a, b)
        return True


def near_links(fps: np.ndarray, forest: Forest, max_distance: int) -> list[tuple[int, int]]:
    """Links that connect all of ``fps`` (distinct) that are connected by small distances."""
    found = []
    rest = fps
    while len(rest) > 1:
        # From one fingerprint outwards: compare each reached one with those not reached so far.
        border, rest = [rest[0]], rest[1:]
        while border and len(rest):
            at = border.pop()
            # As unsigned: of a negative number numpy counts the bits of its absolute value.
            close = np.bitwise_count((rest ^ at).view(np.uint64)) <= max_distance
            if close.any():
                reached, rest = rest[close], rest[~close]
                for other in reached.tolist():
                    if forest.join(int(at), other):
                        found.append((int(at), other))
                border.extend(reached)
    return found


LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def compare_groups(max_distance: int, limit: int):
    """For partitions sorted by key: links of each key's fingerprints; (fingerprint, null) for those
    of a key that has over ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        huge = None  # the key that has been given up

        def handle(keys: np.ndarray, fps: np.ndarray) -> list[tuple]:
            edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
            sizes = np.diff(edges)
            out: list[tuple] = []
            for k in np.flatnonzero(sizes > 1):
                own = fps[edges[k] : edges[k + 1]]
                if len(own) == 2:
                    a, b = own.tolist()
                    if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= max_distance and forest.join(a, b):
                        out.append((a, b))
                elif len(own) <= limit:
                    out += near_links(own, forest, max_distance)
                else:
                    out += [(x, None) for x in own.tolist()]
            return out

        for batch in batches:
            new_keys = batch.column("key").to_numpy(zero_copy_only=False)
            new_fps = batch.column("fp").to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            if huge is not None:
                more = new_keys == huge
                out += [(x, None) for x in new_fps[more].tolist()]
                new_keys, new_fps = new_keys[~more], new_fps[~more]
                if len(new_keys):
                    huge = None
            keys, fps = np.concatenate([keys, new_keys]), np.concatenate([fps, new_fps])
            if len(keys):
                open_from = int(np.searchsorted(keys, keys[-1], side="left"))
                if len(keys) - open_from > limit:
                    huge, open_from = keys[-1], len(keys)
                if open_from:
                    out += handle(keys[:open_from], fps[:open_from])
                    keys, fps = keys[open_from:], fps[open_from:]
            if out:
                yield _links(out)
        if len(keys) and (out := handle(keys, fps)):
            yield _links(out)

    return run


def _links(rows: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def segment_balls(fp: Column) -> Column:
    """Both segments' values at a distance of at most one, each with its segment's number above it."""
    shifts = [F.lit(0)] + [F.shiftleft(F.lit(1).cast("long"), i) for i in range(32)]
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(fp, 32)
    mark = F.lit(1 << 32)
    return F.array(
        *[low.bitwiseXOR(s) for s in shifts],
        *[high.bitwiseXOR(s).bitwiseOR(mark) for s in shifts],
    )


def two_bit_ball(fp: Column) -> Column:
    """All 2,081 values at most two bits from ``fp``."""
    one = F.expr("transform(sequence(0, 63), i -> shiftleft(1L, i))")
    pairs = F.expr(
        "flatten(transform(sequence(0, 62), i -> transform(sequence(i + 1, 63), j -> shiftleft(1L, i) | shiftleft(1L, j))))"
    )
    return F.transform(F.concat(F.array(F.lit(0).cast("long")), one, pairs), lambda x: fp.bitwiseXOR(x))


def fingerprint_links(fps: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) that leave no near pair unconnected."""
    spark = fps.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    meet = fps.select("fp", F.explode(segment_balls(F.col("fp"))).alias("key"))
    found = written(
        meet.repartition(n, "key")
        .sortWithinPartitions("key")
        .mapInArrow(compare_groups(MAX_DISTANCE, group_limit), LINKS),
        "near",
    )
    crowded = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    around = crowded.select("fp", F.explode(two_bit_ball(F.col("fp"))).alias("centre"))
    stars = around.groupBy("centre").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    links = around.join(stars, "centre").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return found.filter("b IS NOT NULL").unionByName(links)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_limit: int = GROUP_LIMIT,
    shingle: int = 4,
) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``.

    Words are lower-cased (A-Z) and cut at white space, shingles have ``shingle`` words, fingerprints at
    most four bits apart are linked, and ``component_id`` is the smallest id that links reach.  A
    null, empty or blank text has fingerprint zero and is linked like any other.  A null id never
    names a component (it does if there is no other).  Repeated rows give repeated results, other
    columns are not read, an empty table gives an empty result.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = written(marked.groupBy("fp").agg(F.min(id_col).alias("first_id")), "distinct")
    roots = components(fingerprint_links(fps.select("fp"), group_limit))
    placed = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = placed.join(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
    return marked.join(named.select("fp", "component_id"), "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    similarity: float | None = None,
) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; all columns of ``docs``.

    Groups are those of ``near_duplicates`` or, with a ``similarity``, those of texts whose sets of
    shingles have at least this Jaccard similarity.  Rows that share an id are one document: they
    stay or go together.
    """
    if similarity is None:
        found = near_duplicates(docs, id_col, text_col, shingle=shingle)
    else:
        found = jaccard.near_duplicates(docs, id_col, text_col, shingle, similarity)
    kept = found.filter(F.col(id_col).eqNullSafe(F.col("component_id")))
    ids = kept.select(F.col(id_col).alias("__kept")).distinct()
    return docs.join(ids, F.col(id_col).eqNullSafe(F.col("__kept")), "left_semi")
