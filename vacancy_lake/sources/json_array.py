"""Large JSON files of one array, read by many tasks.

Spark splits a text file at a delimiter, and a closing brace is one: no byte of a longer UTF-8 character equals it,
and every record ends with one.  What a split cannot know is whether it begins within a string, and how deep.  A
first pass counts quotes and brackets of each split; sums of those over the splits before it tell where each begins.
A second pass then cuts the splits at their record ends.  Only pieces of records that lie across splits are
gathered, a record at a time.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .scratch import scratch_path

_ESCAPED = re.compile(rb"\\.", re.S)
_SPACE = b" \t\r\n"
#: What stands before a record: the array's begin, or a comma.
_FIRST, _NEXT = re.compile(rb"[ \t\r\n]*\[[ \t\r\n]*"), re.compile(rb"[ \t\r\n]*,[ \t\r\n]*")
_NOTHING = re.compile(rb"[ \t\r\n]*")
_BOM = b"\xef\xbb\xbf"


def depth_changes(chunk: bytes) -> tuple[int, int, int]:
    """Quotes of a chunk (modulo two), and the change of depth if it begins outside and inside of a string."""
    parts = _ESCAPED.sub(b"", chunk).split(b'"') if b"\\" in chunk else chunk.split(b'"')
    change = [0, 0]
    for k, part in enumerate(parts):
        change[k % 2] += part.count(b"{") + part.count(b"[") - part.count(b"}") - part.count(b"]")
    return (len(parts) - 1) % 2, change[0], change[1]


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """path (its hash), start (of the split), size (of the file), at (order within the split), value: text between braces."""
    lines = spark.read.option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    return lines.select(
        F.xxhash64(meta["file_path"]).alias("path"), meta["file_block_start"].alias("start"), meta["file_size"].alias("size"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"),
    )


def _opened(start: int, first: bool, value: bytes) -> bytes:
    """A chunk with the brace before it; the file's first one has none."""
    return value.removeprefix(_BOM) if start == 0 and first else b"}" + value


SUMMARY = "path long, start long, size long, quotes int, outside long, inside long, bytes long, kind string"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, list[bytes]]]:
    """Split, place in the batch, and chunks of each run of rows of one split."""
    path, start = (batch.column(c).to_numpy() for c in ("path", "start"))
    cuts = np.flatnonzero((np.diff(path) != 0) | (np.diff(start) != 0)) + 1 if len(path) else []
    for i, j in itertools.pairwise([0, *cuts, len(path)]):
        if j > i:
            yield (int(path[i]), int(start[i])), int(i), batch.column("value").slice(i, j - i).to_pylist()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, size, quoted, outside, inside, read, kind = None, 0, 0, 0, 0, 0, None

    def row() -> pa.RecordBatch:
        values, types = [*now, size, quoted, outside, inside, read, kind], [*[pa.int64()] * 3, pa.int32(), *[pa.int64()] * 3, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[x.split(" ")[0] for x in SUMMARY.split(", ")])

    for batch in batches:
        for split, i, values in _runs(batch):
            first = split != now
            if first:
                if now is not None:
                    yield row()
                now, size, quoted, outside, inside, read, kind = split, batch.column("size")[i].as_py(), 0, 0, 0, 0, None
            for value in values:
                text = _opened(split[1], first, value)
                first = False
                quotes, *change = depth_changes(text)
                outside += change[quoted]
                inside += change[1 - quoted]
                quoted ^= quotes
                read += len(value) + 1
                if split[1] == 0 and kind is None:
                    kind = text.strip(_SPACE)[:1].decode("latin-1") or None
    if now is not None:
        yield row()


def _begins(spark: SparkSession, path: str) -> DataFrame:
    """path, start, quoted, depth of every split of every sound file that is one array or one object.

    A row for each split is written; the second pass is joined with it.
    """
    found = _chunks(spark, path).select("path", "start", "size", "value").mapInArrow(_summaries, SUMMARY)
    folder = scratch_path(spark, "splits")
    found.write.parquet(folder)
    found = spark.read.schema(SUMMARY).parquet(folder)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("path")
    found = found.withColumn("quoted", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    found = found.withColumn("change", F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside")))
    found = found.withColumns(
        {
            "depth": F.coalesce(F.sum("change").over(before), F.lit(0)),
            "quotes_of_file": F.sum("quotes").over(of_file) % 2,
            "depth_of_file": F.sum("change").over(of_file),
            "kind": F.max("kind").over(of_file),
            # Every chunk counts a delimiter; a file that ends without one has a byte less.
            "closed": (F.sum("bytes").over(of_file) == F.col("size")).cast("int"),
            "last": F.col("start") == F.max("start").over(of_file),
        }
    )
    sound = (F.col("quotes_of_file") == 0) & F.col("kind").isin("[", "{") & (F.col("depth_of_file") == F.col("closed"))
    return found.filter(sound).select("path", "start", "quoted", "depth", "kind", "closed", "last")


#: whole: a record; head, tail: what stands in a split before its first and after its last record end.  A split
#: without a record end has a head only.
PIECE = "path long, start long, kind string, place int, value binary"
WHOLE, HEAD, TAIL = 0, 1, 2


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split(" ")[0] for x in PIECE.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary()]
    out, now, held, quoted, depth, kind, ended, closed = [], None, [], 0, 0, "[", False, False

    def table() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    def close() -> None:
        # The brace that ends a file begins no chunk.
        out.append((*now, kind, TAIL if ended else HEAD, b"".join(held) + b"}" * closed))

    for batch in batches:
        for split, i, values in _runs(batch):
            first = split != now
            if first:
                if now is not None:
                    close()
                now, held, ended = split, [], False
                quoted, depth, kind = (batch.column(c)[i].as_py() for c in ("quoted", "depth", "kind"))
                closed = batch.column("last")[i].as_py() and batch.column("closed")[i].as_py() == 1
            base = 1 if kind == "[" else 0
            for value in values:
                text = _opened(split[1], first, value)
                if not quoted and depth - 1 == base and not (first and split[1] == 0):
                    # A record ends with the brace that the chunk begins with.
                    held.append(b"}")
                    out.append((*split, kind, WHOLE if ended else HEAD, b"".join(held)))
                    held, ended = [value], True
                else:
                    held.append(text)
                first = False
                quotes, outside, inside = depth_changes(text)
                depth += inside if quoted else outside
                quoted ^= quotes
        if out:
            yield table()
    if now is not None:
        close()
        yield table()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces without what stands around a record; ``bad`` where something else does."""
    for batch in batches:
        paths, values, bad = batch.column("path").to_pylist(), [], []
        for kind, value in zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist(), strict=True):
            # Within an array a record stands after a bracket or a comma; it is an object.
            head = (_FIRST.match(value) or _NEXT.match(value)) if kind == "[" else _NOTHING.match(value)
            text = value[head.end() :] if head else b""
            values.append(text)
            bad.append(text[:1] != b"{")
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(values, pa.binary()), pa.array(bad)], names=["path", "value", "bad"])


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of JSON files that are one array of objects, or one object, in any number of tasks.

    A missing path gives an empty table.  A file that is malformed anywhere gives no rows; an empty file and an empty
    array have none.  Unknown fields are left out, missing ones null.
    """
    try:
        begins = _begins(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    dealt = _chunks(spark, path).join(begins, ["path", "start"]).sortWithinPartitions("path", "start", "at")
    # Written, as both the records and what tells sound files from malformed ones come from it.
    folder = scratch_path(spark, "records")
    dealt.select("path", "start", "quoted", "depth", "kind", "closed", "last", "value").mapInArrow(_pieces, PIECE).write.parquet(folder)
    pieces = spark.read.schema(PIECE).parquet(folder)
    # Pieces across splits: a tail, splits without a record end, and a head are one record.
    parts = pieces.filter(F.col("place") != WHOLE)
    # A record is told by the split of its tail; it goes on up to the next head that is closed.
    order = Window.partitionBy("path").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.coalesce(F.last(F.when(F.col("place") == TAIL, F.col("start")), ignorenulls=True).over(order), F.lit(-1))
    gathered = parts.withColumn("record", begun).groupBy("path", "kind", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", F.hex("value").alias("value")))).alias("ps")
    )
    across = gathered.select("path", "kind", F.unhex(F.array_join(F.transform("ps", lambda p: p["value"]), "")).alias("value"))
    # The last piece of a file is what closes the array.
    ends = F.decode("value", "ISO-8859-1").rlike(r"^[ \t\r\n]*\]?[ \t\r\n]*$|^[ \t\r\n]*\[[ \t\r\n]*\][ \t\r\n]*$")
    texts = pieces.filter(F.col("place") == WHOLE).select("path", "kind", "value").unionByName(across.filter(~ends))
    records = texts.mapInArrow(_records, "path long, value binary, bad boolean")
    with_bad = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    options = {"columnNameOfCorruptRecord": "__bad", "mode": "PERMISSIVE"}
    parsed = records.select("path", "bad", F.from_json(F.col("value").cast("string"), with_bad, options).alias("r"))
    parsed = parsed.withColumn("wrong", F.col("bad") | F.col("r").isNull() | F.col("r.__bad").isNotNull())
    spoilt = parsed.filter("wrong").select("path").distinct()
    return parsed.filter("NOT wrong").join(spoilt, "path", "left_anti").select(*[F.col("r").getField(n).alias(n) for n in schema.names])
