"""Incremental ingest: new record files as a stream, insert-only upserts with a log of what is committed.

A target is a folder of batches, ``data/run=<run>/batch=<number>/bucket=<hash>``, and a log with a row for each batch
that is whole.  A run is a query with its checkpoint: the same checkpoint goes on with the run, a new one begins
another.  A batch's row is written last, so what a dying job leaves behind is never read, and known keys are those
of all committed batches, whoever wrote them.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import has_key, keep_first, normalize_url

#: A row of the log: ``folder`` is the batch's below the target, ``schema`` that of its rows as JSON.
COMMIT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("run", "folder", "schema")]
    + [T.StructField(n, T.LongType()) for n in ("batch", "rows", "seen")]
)
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_stream(spark: SparkSession, path: str, schema: T.StructType, kind: str = "json", files: int = 1000) -> DataFrame:
    """Record files as they land; at most ``files`` of them in one batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(path)


def commits(spark: SparkSession, target: str) -> DataFrame:
    """The log: a row for each committed batch, with its new rows and the rows it has seen.  None for a new target."""
    try:
        return spark.read.schema(COMMIT).json(f"{target}/_commits/*")
    except AnalysisException as e:
        if e.getCondition() not in _ABSENT:
            raise
        return spark.createDataFrame([], COMMIT)


def read_target(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """All committed rows with ``run``, ``batch`` and ``bucket``; rows of batches that were not committed are not
    seen.  A target without any row is empty and has the columns of ``schema`` or of its log."""
    # One row a batch; a run that takes 1000 files a batch has few of them.
    log = commits(spark, target).orderBy("run", "batch").collect()
    found = schema or (T.StructType.fromJson(json.loads(log[-1].schema)) if log else T.StructType([]))
    own = T.StructType([*found.fields, *[T.StructField(n, k) for n, k in (("run", T.StringType()), ("batch", T.LongType()), ("bucket", T.IntegerType()))]])
    folders = [f"{target}/{r.folder}" for r in log if r.rows]
    if not folders:
        return spark.createDataFrame([], own)
    return spark.read.schema(own).option("basePath", f"{target}/data").parquet(*folders)


def _counted(seen: Observation) -> int:
    try:
        return seen.get["rows"]
    except Py4JJavaError:  # no row is handed over where the plan was seen to be empty and did not run
        return 0


def run_of(spark: SparkSession) -> str:
    """The id that the running query keeps in its checkpoint."""
    found = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("not within a streaming query: name the run")
    return found


def insert_new(target: str, key: str, order: list[str], buckets: int = 64, run: str | None = None) -> Callable[[DataFrame, int], None]:
    """A batch function: the first row of each key that ``target`` does not have is appended.

    Rows whose key is null or empty are passed over; rows of a batch that share a key are ordered by ``order``.
    A batch that this run has committed before does nothing; one that died half-way is written anew.  Keys are dealt
    to ``buckets`` folders by hash, and a batch reads only the keys of the folders that its own keys belong to.
    Runs that write to a target at the same time do not see each other's batches: let one end before the next.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own_run = run or run_of(spark)
        if not commits(spark, target).filter((F.col("run") == own_run) & (F.col("batch") == batch_id)).isEmpty():
            return
        folder = f"data/run={own_run}/batch={batch_id}"
        seen, added = Observation(), Observation()
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        keyed = batch.observe(seen, F.count("*").alias("rows")).filter(has_key(key))
        new = keep_first(keyed, F.col(key), order).withColumn("bucket", bucket).persist()
        try:
            own = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
            known = read_target(spark, target, batch.schema).filter(F.col("bucket").isin(own)).select(key)
            rest = new.join(known, key, "left_anti").select(*new.columns).observe(added, F.count("*").alias("rows"))
            rest.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/{folder}")
            row = (own_run, folder, batch.schema.json(), batch_id, _counted(added), _counted(seen))
        finally:
            new.unpersist()
        # Last of all: one small file, which appears when it is whole.
        spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("overwrite").json(f"{target}/_commits/{own_run}-{batch_id}")

    return write


def ingest(
    stream: DataFrame, target: str, checkpoint: str, url: str = "url", order: list[str] | None = None
) -> StreamingQuery:
    """Starts a run that takes all files that have landed, then ends; the next run goes on from there.

    With a new checkpoint, after the old one was lost, all files that are still there are taken again and add only
    what the target does not have.
    """
    keyed = stream.withColumn("normalized_url", normalize_url(F.col(url)))
    batch = insert_new(target, "normalized_url", order or [url])
    return (
        keyed.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
