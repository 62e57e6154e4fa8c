"""Overlay upserts that rewrite only the files that hold an incoming key.

A table is a set of slices, each a folder of rows between two keys, and a manifest of the slices it consists of.  An
update deals its keys to the slices by their first keys, overlays the slices that get any, and writes these as new
slices; then a manifest names the new slices and those that were left alone.  It is written last, so a job that dies
changes nothing.  Postings are numbered as they appear, so most updates fall into few slices.
"""

from __future__ import annotations

import bisect
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ingest import has_key, overlay

ROWS_PER_SLICE = 1_000_000
#: Rows that one task writes, as slices.
ROWS_PER_TASK = 1_000_000
#: First keys of so many slices go to the tasks that deal out an update.
MOST_SLICES = 200_000


def _manifest(key: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("slice", T.StringType()), T.StructField("low", key), T.StructField("rows", T.LongType()), T.StructField("schema", T.StringType())])


def version_of(spark: SparkSession, target: str) -> int:
    """The newest version, 0 for a table that was never written."""
    try:
        found = spark.read.parquet(f"{target}/_manifests").agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0
    return found or 0


def slices(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """slice, low (its first key), rows, schema of a version, by default the newest."""
    found = version_of(spark, target) if version is None else version
    return spark.read.parquet(f"{target}/_manifests/version={found}")


def _rows(spark: SparkSession, target: str, names: list[str], schema: T.StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    folders = [f"{target}/data/slice={n}" for n in names]
    return spark.read.schema(schema).option("basePath", f"{target}/data").parquet(*folders).select(*schema.names)


def read_keyed(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The rows of a version; columns that later updates brought are null in slices they left alone."""
    now = slices(spark, target, version)
    found = now.select("slice", "rows").collect()  # one row a slice
    schema = T.StructType.fromJson(json.loads(now.select("schema").first().schema))
    return _rows(spark, target, [r.slice for r in found if r.rows], schema)


def _cut(key: str, rows_per_slice: int):
    """For a task's rows sorted by slice and key: the same with ``__n``, which grows where a slice ends or has
    enough rows.  Rows of one key stay together; what is left of a slice, if under half of one, stays with the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held, last, split = 0, 0, None, False
        waiting: list[tuple[pa.RecordBatch, list[int]]] = []  # up to the rows of a slice that may be a rest

        def joined() -> None:
            """The open slice, if it is a rest, goes to the one before it."""
            if split and 2 * held < rows_per_slice:
                for _, labels in waiting:
                    for k in range(len(labels) - 1, -1, -1):
                        if labels[k] != n:
                            break
                        labels[k] = n - 1

        def made() -> Iterator[pa.RecordBatch]:
            for batch, labels in waiting:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.int32())], names=[*batch.schema.names, "__n"])
            waiting.clear()

        for batch in batches:
            labels: list[int] = []
            waiting.append((batch, labels))
            for now in zip(batch.column("__slice").to_pylist(), batch.column(key).to_pylist(), strict=True):
                if last is not None and now[0] != last[0]:
                    joined()
                    n, held, split = n + 1, 0, False
                elif held >= rows_per_slice and now != last:
                    n, held, split = n + 1, 0, True
                held, last = held + 1, now
                labels.append(n)
            if not split or 2 * held >= rows_per_slice:
                yield from made()
        joined()
        yield from made()

    return run


def _write(df: DataFrame, target: str, key: str, version: int, rows: int, rows_per_slice: int, kept: DataFrame | None) -> None:
    """``df`` (with ``__slice``, the number of the slice a row comes from) as new slices of a new version."""
    spark, attempt = df.sparkSession, uuid.uuid4().hex[:8]
    schema = df.drop("__slice").schema
    folder = f"{target}/data"
    # A task writes many slices: tasks by rows, not by slices, or their results alone would fill the driver.
    wanted = -(-rows // rows_per_slice) or 1
    tasks = max(min(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-rows // ROWS_PER_TASK))
    ranged = df.repartitionByRange(tasks, "__slice", key).sortWithinPartitions("__slice", key)
    cut = ranged.mapInArrow(_cut(key, rows_per_slice), T.StructType([*df.schema.fields, T.StructField("__n", T.IntegerType())]))
    named = F.concat_ws("-", F.lit(version), F.lit(attempt), F.spark_partition_id(), F.col("__n"))
    cut.withColumn("slice", named).drop("__slice", "__n").write.mode("append").partitionBy("slice").parquet(folder)
    written = spark.read.schema(T.StructType([schema[key], T.StructField("slice", T.StringType())])).parquet(folder)
    own = written.filter(F.col("slice").startswith(f"{version}-{attempt}-")).groupBy("slice").agg(F.min(key).alias("low"), F.count("*").alias("rows"))
    text = F.lit(schema.json()).alias("schema")
    manifest = own.select("slice", "low", "rows", text)
    if kept is not None:
        manifest = manifest.unionByName(kept.select("slice", "low", "rows", text))
    # A table without rows has a manifest with its schema only.
    bare = spark.createDataFrame([(None, None, 0, schema.json())], _manifest(schema[key].dataType))
    manifest = manifest if rows else bare
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{target}/_manifests/version={version}")


def create_keyed(df: DataFrame, target: str, key: str, rows_per_slice: int = ROWS_PER_SLICE) -> None:
    """``df`` as a new table (as another version of one that is there).  Rows with a null or empty key are left out."""
    kept = df.filter(has_key(key)).withColumn("__slice", F.lit(0))
    _write(kept, target, key, version_of(df.sparkSession, target) + 1, kept.count(), rows_per_slice, None)


def overlay_keyed(new: DataFrame, target: str, key: str, rows_per_slice: int = ROWS_PER_SLICE) -> dict[str, int]:
    """Overlays ``new`` (one row a key) on the table: new rows replace old ones field by field, nulls too, fields that
    only the table has stay, keys it does not have are added.  Rows with a null or empty key are left out.

    Returns slices: how many there were, rewritten: how many of them were read and written again.
    """
    spark = new.sparkSession
    version = version_of(spark, target)
    now = slices(spark, target, version)
    found = now.select("slice", "low", "rows").orderBy("low").collect()
    if len(found) > MOST_SLICES:
        raise ValueError(f"more than {MOST_SLICES} slices: write the table with more rows in each")
    schema = T.StructType.fromJson(json.loads(now.select("schema").first().schema))
    found = [r for r in found if r.rows]
    lows = spark.sparkContext.broadcast([r.low for r in found])

    def number(keys: list) -> list[int]:
        return [max(0, bisect.bisect_right(lows.value, k) - 1) for k in keys]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pa.array(number(batch.column(key).to_pylist()), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, at], names=[*batch.schema.names, "__slice"])

    dealt = new.filter(has_key(key)).mapInArrow(deal, T.StructType([*new.schema.fields, T.StructField("__slice", T.IntegerType())]))
    # At most one row a slice.
    touched = {r["__slice"]: r["n"] for r in dealt.groupBy("__slice").agg(F.count("*").alias("n")).collect()}
    if not touched:
        return {"slices": len(found), "rewritten": 0}
    names = {found[k].slice: k for k in touched if found}
    old = _rows(spark, target, list(names), schema).mapInArrow(deal, T.StructType([*schema.fields, T.StructField("__slice", T.IntegerType())]))
    rows = sum(touched.values()) + sum(found[k].rows for k in names.values())
    kept = now.filter((F.col("rows") > 0) & ~F.col("slice").isin(list(names)))
    _write(overlay(old, dealt, key), target, key, version + 1, rows, rows_per_slice, kept)
    return {"slices": len(found), "rewritten": len(names)}
