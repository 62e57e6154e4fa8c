"""Landing of records in folders by crawl date and role: files by size, each run once.

A run's records go to ``run=<run>/crawl_date=<date>/role=<role>``.  Rows are counted by date and role first, and a
folder gets as many tasks as its count asks for: a large one is salted over several, a small one is one file,
whatever the number of tasks that read the input.  A run's entry in the log is written last; only runs in the log
are read, and a run that is there is not landed again.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import scratch_path

#: More pairs of date and role than this are not broadcast (some 50 bytes each).
BROADCAST_FOLDERS = 500_000
PARTITIONS = ("crawl_date", "role")
LOG = T.StructType([T.StructField("run", T.StringType()), T.StructField("schema", T.StringType()), T.StructField("kind", T.StringType())])
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def landed(spark: SparkSession, path: str) -> DataFrame:
    """The log: run, schema, kind of each whole run.  None for a new folder."""
    try:
        return spark.read.schema(LOG).json(f"{path}/_landed/*")
    except AnalysisException as e:
        if e.getCondition() not in _ABSENT:
            raise
        return spark.createDataFrame([], LOG)


def dealt(marked: DataFrame, rows_per_file: int) -> DataFrame:
    """``marked`` shuffled so that each folder's rows are in as many tasks as its count asks for.

    A row's task is taken from its content, so a task that is run again gets the same rows.
    """
    spark = marked.sparkSession
    path = scratch_path(spark, "folders")
    files = F.ceil(F.count("*") / rows_per_file).cast("int").alias("__files")
    marked.groupBy(*PARTITIONS).agg(files).write.parquet(path)
    counts = spark.read.parquet(path).withColumnsRenamed({p: f"__{p}" for p in PARTITIONS})
    if counts.count() <= BROADCAST_FOLDERS:
        counts = F.broadcast(counts)
    same = [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in PARTITIONS]
    content = F.xxhash64(*[F.col(f"`{c}`") for c in marked.columns])
    salted = marked.join(counts, same[0] & same[1], "left").withColumn("__file", F.pmod(content, F.col("__files")))
    return salted.repartition(*PARTITIONS, "__file").select(*[f"`{c}`" for c in marked.columns])


def land(
    df: DataFrame, path: str, crawl_date: Column, role: Column, run: str, kind: str = "json", rows_per_file: int = 1_000_000
) -> bool:
    """Lands all rows of ``df`` as ``run``; False if that run is landed already.

    Repeated rows all stay.  A null date or role has a folder of its own.  Many equal rows meet in one task, which
    begins a new file after ``rows_per_file``.  Columns named as the folders are replaced by them.
    """
    spark = df.sparkSession
    if not landed(spark, path).filter(F.col("run") == run).isEmpty():
        return False
    marked = df.withColumns({"crawl_date": crawl_date.cast("string"), "role": role.cast("string")})
    out = dealt(marked, rows_per_file).write.mode("overwrite").partitionBy(*PARTITIONS)
    out.option("maxRecordsPerFile", rows_per_file).format(kind).save(f"{path}/run={run}")
    _commit(spark, path, run, marked.schema, kind)
    return True


def _commit(spark: SparkSession, path: str, run: str, schema: T.StructType, kind: str) -> None:
    # Last of all: one small file.
    spark.createDataFrame([(run, schema.json(), kind)], LOG).coalesce(1).write.mode("overwrite").json(f"{path}/_landed/{run}")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all landed runs with ``run``, ``crawl_date`` and ``role``; columns that a run lacks are null."""
    found = None
    # One row a run; a schema and kind that many runs share is one read.
    reads: dict[tuple[str, str], list[str]] = {}
    for r in landed(spark, path).collect():
        reads.setdefault((r.schema, r.kind), []).append(r.run)
    for (schema, kind), names in sorted(reads.items()):
        own = T.StructType.fromJson(json.loads(schema)).add("run", "string")
        df = spark.read.schema(own).option("basePath", path).format(kind).load([f"{path}/run={n}" for n in sorted(names)])
        found = df if found is None else found.unionByName(df, allowMissingColumns=True)
    return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in (*PARTITIONS, "run")])) if found is None else found
