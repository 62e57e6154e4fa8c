"""I-Match document fingerprints: a text is told by its terms of middling document frequency.

Terms of a chosen band of inverse document frequency are the lexicon.  Of each text the distinct lexicon
terms are sorted and hashed: once over the whole lexicon, and once over each of several random subsets of
it.  A changed word changes only the hashes of the subsets that hold it, so the share of equal hashes tells
how like two texts are.  Subsets are drawn at several rates: sparse ones, which hold a word or two of a long text
and so measure its likeness best, and denser ones for short texts, of which sparse ones hold nothing.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .batches import slices, texts_of
from .store import written

#: Lexicon terms have log10(documents / documents with the term) in this band, and occur in MIN_DOCS at least.
IDF_BAND = (1.0, 4.0)
MIN_DOCS = 2
#: Rates at which subsets keep a term (one in ..., powers of two), the sparsest first, and subsets of each rate.
RATES, PER_RATE = (512, 128, 32, 8), 8
SUBSETS = len(RATES) * PER_RATE
WHOLE, PART = 16, 8  # hex digits of the hash over the whole lexicon, and of one subset's
EMPTY = "-" * PART
#: Two texts are compared by the sparsest rates at which so many subsets hold a term of either.
LEAST_FILLED = 6
#: A lexicon of so many terms goes to every worker.  A term has at least 1 of 10**IDF_BAND[1] documents, so there are
#: at most 10**IDF_BAND[1] times as many terms as a document has distinct words on average, however many documents
#: there are; a larger lexicon is joined.
BROADCAST_TERMS = 500_000
#: A task hands on its counts when it holds so many different words.
COUNTED_TERMS = 200_000

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of other characters, makes the rest spaces.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> set[bytes]:
    return set(text.translate(LETTERS).split())


def subsets_of(term: bytes) -> tuple[int, ...]:
    """Numbers of the subsets that hold a term: those whose own bits of its hash are all zero."""
    bits, found, k = xxhash.xxh128_intdigest(term, 11) | xxhash.xxh128_intdigest(term, 12) << 128, [], 0
    for rate in RATES:
        for _ in range(PER_RATE):
            if not bits & (rate - 1):
                found.append(k)
            bits >>= rate.bit_length() - 1
            k += 1
    return tuple(found)


def fingerprint(kept: Iterable[bytes], text: bytes, subsets=subsets_of) -> str:
    """Of the lexicon terms of a text.  A text without any is told by all its characters instead."""
    terms = sorted(kept)
    if not terms:
        return xxhash.xxh64_hexdigest(text, 1) + EMPTY * SUBSETS
    groups: dict[int, list[bytes]] = {}
    for term in terms:
        for k in subsets(term):
            groups.setdefault(k, []).append(term)
    parts = [xxhash.xxh32_hexdigest(b" ".join(groups[k])) if k in groups else EMPTY for k in range(SUBSETS)]
    return xxhash.xxh64_hexdigest(b" ".join(terms)) + "".join(parts)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets that hold a term of either text, from the sparsest rate on, as many
    rates as are needed; where all rates together hold too few, the whole lexicon's hash counts, too.  1 for equal
    fingerprints."""
    if a == b:
        return 1.0
    filled = equal = 0
    for k in range(SUBSETS):
        x, y = a[WHOLE + PART * k : WHOLE + PART * (k + 1)], b[WHOLE + PART * k : WHOLE + PART * (k + 1)]
        if k % PER_RATE == 0 and filled >= LEAST_FILLED:
            break
        if x != EMPTY or y != EMPTY:
            filled += 1
            equal += x == y
    if filled < LEAST_FILLED:
        filled += 1
        equal += a[:WHOLE] == b[:WHOLE]
    return equal / filled


class Terms(dict):
    """The lexicon in a worker: term -> numbers of its subsets, filled in as terms are met."""

    def of(self, term: bytes) -> tuple[int, ...]:
        found = self[term]
        if found is None:
            found = self[term] = subsets_of(term)
        return found


_KNOWN: dict[str, Terms] = {}


class Lexicon:
    """A lexicon that fits every worker; each worker builds its table once."""

    def __init__(self, spark, terms: pa.Array) -> None:
        self.key, self.sent = uuid.uuid4().hex, spark.sparkContext.broadcast(terms)

    def terms(self) -> Terms:
        if self.key not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[self.key] = Terms.fromkeys(self.sent.value.to_pylist())
        return _KNOWN[self.key]


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """term (binary), n: in how many texts each term stands.  Counts are added up within a task first."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in texts_of(batch, text_col):
                if text:
                    counts.update(terms_of(text))
            if len(counts) >= COUNTED_TERMS:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    counted = docs.select(text_col).mapInArrow(run, "term binary, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def lexicon_of(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = IDF_BAND, min_docs: int = MIN_DOCS) -> DataFrame:
    """term, frequent of all terms that are not too rare: those of the lexicon, and the frequent ones above it."""
    total = docs.count()
    low, high = band
    counts = document_frequencies(docs, text_col).filter(F.col("n") >= max(min_docs, math.ceil(total / 10**high - 1e-9)))
    return counts.select("term", (F.col("n") > total / 10**low + 1e-9).alias("frequent"))


def _decoded(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


LINKED = "part int, seq long, last boolean, doc_id {id}, n_chars long, edited_sha256 string, {more}"
MARKS = "fingerprint string, edited_fingerprint string, near_edited double, near_next double, text string"
TEXTS = "text string, edited string"


def _edited(own: str, after: str) -> str:
    half = len(own) // 2
    return own[: len(own) - half] + after[:half]


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class _Marker:
    """Fingerprints of texts, and what is told of a text by its own and the next one."""

    def __init__(self, lexicon: Lexicon | None) -> None:
        self.terms = lexicon.terms() if lexicon else None

    def mark(self, text: str) -> str | None:
        if self.terms is None:
            return None
        data, known = text.encode(), self.terms
        return fingerprint([t for t in terms_of(data) if t in known], data, known.of)

    def row(self, own: str, mark: str | None, after: str, after_mark: str | None, keep: bool) -> tuple:
        edited = _edited(own, after)
        if self.terms is None:
            return len(own), _digest(edited), own, edited
        edited_mark = self.mark(edited)
        near = likeness(mark, edited_mark), likeness(mark, after_mark)
        return len(own), _digest(edited), mark, edited_mark, *near, own if keep else None


def _linked(docs: DataFrame, lexicon: Lexicon | None) -> DataFrame:
    """Every document with its next one, by doc_id (null first) and then by the text's hash.

    Documents are dealt out by ranges of that order and sorted, so the next one is the next row of the task, but
    for a range's last row: these meet the first rows of the next ranges in a second, small step.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = LINKED.format(id=kind, more=TEXTS if lexicon is None else MARKS)
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).repartitionByRange("doc_id", "h")
    ordered = ordered.sortWithinPartitions("doc_id", "h", "text").select(F.spark_partition_id().alias("part"), "doc_id", "text")
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def table(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.types, strict=True)], names=names)

    def types_of(doc_id: pa.DataType) -> pa.Schema:
        kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}
        return pa.schema([(n, doc_id if n == "doc_id" else kinds[x.split(" ")[1]]) for n, x in zip(names, schema.split(", "), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marker, before, types, seq = _Marker(lexicon), None, None, 0
        for batch in slices(batches):
            types = types or types_of(batch.schema.field("doc_id").type)
            rows = []
            for part, doc_id, text in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), _decoded(batch, "text"), strict=True):
                mark = marker.mark(text)
                if before is not None:
                    rows.append((part, seq, False, before[0], *marker.row(*before[1:], text, mark, seq == 0)))
                    seq += 1
                before = doc_id, text, mark
            if rows:
                yield table(rows, types)
        if before is not None:
            # Next to itself for now: its true neighbour is another task's.
            yield table([(part, seq, True, before[0], *marker.row(*before[1:], *before[1:], True))], types)

    done = written(ordered.mapInArrow(run, schema), "linked")
    firsts = done.filter("seq = 0").select(F.col("part").alias("after"), F.col("text").alias("after_text"))
    # As many rows as there are ranges.
    parts = Window.orderBy("part")
    ranges = done.filter("seq = 0").select("part", F.coalesce(F.lead("part").over(parts), F.min("part").over(parts)).alias("after"))
    ends = done.filter("last").select("part", "seq", "doc_id", "text").join(ranges, "part").join(firsts, "after")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marker = _Marker(lexicon)
        for batch in batches:
            types = types_of(batch.schema.field("doc_id").type)
            rows = []
            at = [batch.column(c).to_pylist() for c in ("part", "seq", "doc_id")]
            for part, seq, doc_id, own, after in zip(*at, _decoded(batch, "text"), _decoded(batch, "after_text"), strict=True):
                rows.append((part, seq, True, doc_id, *marker.row(own, marker.mark(own), after, marker.mark(after), False)))
            if rows:
                yield table(rows, types)

    met = ends.select("part", "seq", "doc_id", "text", "after_text").mapInArrow(meet, schema)
    return done.filter("NOT last").unionByName(met)


def fingerprints_by_join(texts: DataFrame, lexicon: DataFrame, key: str) -> DataFrame:
    """key, fingerprint of every row of ``texts`` (a unique ``key``, text), for a lexicon of any size.

    Words of the texts are joined with the lexicon.  Words above the band, of which there are few, are left out
    before, so no word of the join has more than one in 10**IDF_BAND[0] texts.
    """
    spark = texts.sparkSession
    frequent = spark.sparkContext.broadcast({bytes(r.term) for r in lexicon.filter("frequent").select("term").toLocalIterator()})

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            keys, terms = [], []
            for k, text in zip(batch.column(key).to_pylist(), texts_of(batch, "text"), strict=True):
                own = terms_of(text or b"") - frequent.value
                keys += [k] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(key).type), pa.array(terms, pa.binary())], names=[key, "term"])

    kind = texts.schema[key].dataType.simpleString()
    met = texts.select(key, "text").mapInArrow(words, f"`{key}` {kind}, term binary").join(lexicon.filter("NOT frequent").select("term"), "term")
    kept = met.groupBy(key).agg(F.collect_list("term").alias("terms"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t or [], x or b"") for t, x in zip(batch.column("terms").to_pylist(), texts_of(batch, "text"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, pa.string())], names=[key, "fingerprint"])

    return texts.select(key, "text").join(kept, key, "left").select(key, "text", "terms").mapInArrow(mark, f"`{key}` {kind}, fingerprint string")


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def neighbour_likeness(docs: DataFrame, band: tuple[float, float] = IDF_BAND, min_docs: int = MIN_DOCS, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """The columns of RESULT for every row of ``docs`` (doc_id, text; other columns are not looked at).

    The edited text has its last half replaced by as much of the next document's start; after the last document
    comes the first.  A null text counts as empty.  Rows that share a doc_id follow each other by their texts' hash,
    rows without one come first.  The only document is its own next one.  Equal texts, and texts with the same
    lexicon terms, have equal fingerprints; texts without a lexicon term only if they are equal.
    """
    found = written(lexicon_of(docs, "text", band, min_docs), "lexicon")
    own = found.filter("NOT frequent").select("term")
    if own.count() <= broadcast_terms:
        terms = own.toArrow().column("term").combine_chunks().cast(pa.binary())
        return _linked(docs, Lexicon(docs.sparkSession, terms)).select(*RESULT)
    pairs = _linked(docs, None).withColumn("key", F.struct("part", "seq"))
    pairs = written(pairs.withColumn("key", F.col("part").cast("long") * (1 << 40) + F.col("seq")), "pairs")
    mine = written(fingerprints_by_join(pairs.select("key", "text"), found, "key"), "marks")
    edited = fingerprints_by_join(pairs.select("key", F.col("edited").alias("text")), found, "key")
    # The next row's key: one more, or the first of the next range after a range's last row.
    parts = Window.orderBy("part")
    ranges = pairs.filter("seq = 0").select("part", F.coalesce(F.lead("part").over(parts), F.min("part").over(parts)).alias("after"))
    after = F.when(F.col("last"), F.col("after").cast("long") * (1 << 40)).otherwise(F.col("key") + 1)
    linked = pairs.join(ranges, "part").select("key", "doc_id", "n_chars", "edited_sha256", after.alias("next"))
    near = F.udf(likeness, "double")
    return (
        linked.join(mine, "key")
        .join(edited.withColumnRenamed("fingerprint", "edited_fingerprint"), "key")
        .join(mine.select(F.col("key").alias("next"), F.col("fingerprint").alias("n")), "next")
        .withColumn("near_edited", near("fingerprint", "edited_fingerprint"))
        .withColumn("near_next", near("fingerprint", "n"))
        .select(*RESULT)
    )
