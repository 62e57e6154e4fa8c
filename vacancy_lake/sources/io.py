"""Reading and writing raw, Silver and Gold tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .json_array import read_array


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


#: Files of one array up to this size are read whole by a task; larger ones by splits.
WHOLE_FILE_BYTES = 32 << 20


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """JSON records (files with one array each, or with ``multi_line=False`` one object a line).

    A missing path gives an empty table; a malformed file or line gives no rows.  Where a file of one array is larger
    than ``whole_file_bytes``, files are cut into splits, with the same rows.
    """
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read.schema(with_bad).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    try:
        # Sizes come from the listing, contents are not read.
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] if multi_line else 0
        if (largest or 0) > whole_file_bytes:
            return read_array(spark, path, schema)
        df = reader.json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)
    # Spark does not read the corrupt column alone, as in a count: the filter names a field, too, and is true for any.
    field = F.coalesce(F.length(F.col(schema.names[0]).cast("string")), F.lit(0)) >= 0
    return df.filter(F.col("_corrupt_record").isNull() & field).select(*schema.names)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet or CSV by the path's suffix; ValueError for any other."""
    if path.endswith(".parquet"):
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    raise ValueError(f"neither .parquet nor .csv: {path}")


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SILVER).parquet(path)


def write_silver(df: DataFrame, path: str, kind: str = "parquet") -> bool:
    """Writes unless there is no row; CSV has its lists as JSON.  ValueError for another kind.

    ``df`` runs once where nothing stands at ``path`` yet: its rows are counted while they are written, and a table
    without rows is taken away again.  Over an older table, which an empty one must leave alone, it is asked first.
    """
    if kind not in ("parquet", "csv"):
        raise ValueError(f"neither parquet nor csv: {kind}")
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    new, seen = not files.exists(folder), Observation()
    if not new and df.isEmpty():
        return False
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if kind == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
        flat = df.withColumns({c: F.to_json(c) for c in lists})
        flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    if new and not seen.get["rows"]:
        files.delete(folder, True)
        return False
    return True


def write_gold(tables: dict[str, DataFrame], path: str) -> None:
    """One Parquet table each; an empty one keeps its schema."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")


def read_gold(spark: SparkSession, path: str, names: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """Tables by name; a missing one is empty."""
    found = {}
    for name, schema in names.items():
        try:
            found[name] = spark.read.parquet(f"{path}/{name}.parquet")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            found[name] = empty(spark, schema)
    return found


def register_views(tables: dict[str, DataFrame]) -> None:
    """Tables as temporary views for SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def append_landing(df: DataFrame, path: str, crawl_date: Column, role: Column, kind: str = "json") -> None:
    """Appends records as they come, in folders by crawl date and role."""
    marked = df.withColumn("crawl_date", crawl_date).withColumn("role", role)
    marked.write.mode("append").partitionBy("crawl_date", "role").format(kind).save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """url (the file's path), html of landed pages, one file each."""
    files = spark.read.option("wholetext", True).text(path)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def dataset_status(tables: dict[str, DataFrame]) -> DataFrame:
    """dataset, present, rows of each table; a table of files also has its files and bytes."""

    def status(name: str, df: DataFrame) -> DataFrame:
        files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
        each = files.groupBy("f").agg(F.max("b").alias("b"), F.count("*").alias("n"))
        return each.agg(
            F.lit(name).alias("dataset"),
            (F.count("*") > 0).alias("present"),
            F.count("*").alias("files"),
            F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        )

    return reduce(DataFrame.unionByName, [status(n, df) for n, df in tables.items()])


def write_report(
    results: DataFrame,
    violations: DataFrame,
    path: str,
    timestamp: str,
    source: str = "",
    total_records: int | None = None,
    exit_code: int | None = None,
    formats: tuple[str, ...] = ("md", "json"),
) -> None:
    """One report of a quality run, below ``path`` in a folder for the day of ``timestamp`` (ISO 8601).

    ``report_<timestamp>.json`` holds a line per result with the run's metadata (timestamp, table,
    records, stages, exit code), ``report_<timestamp>.md`` the same as Markdown,
    ``violations_<timestamp>.json`` all violations.  A run that writes again replaces its own report.
    """
    spark = results.sparkSession
    found = results.collect()  # a few dozen rows by construction
    stages = ",".join(dict.fromkeys(r.stage for r in found))
    metadata = {"timestamp": timestamp, "source": source, "total_records": total_records, "stages": stages, "exit_code": exit_code}
    mark = timestamp.replace("T", "_").replace(":", "-").split(".")[0]
    base = f"{path}/{timestamp[:10]}"
    if "json" in formats:
        kinds = {"total_records": "long", "exit_code": "int"}
        more = {k: F.lit(v).cast(kinds.get(k, "string")) for k, v in metadata.items()}
        rows = spark.createDataFrame(found, results.schema).withColumns(more).coalesce(1)
        rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{base}/report_{mark}.json")
    if "md" in formats:
        text = spark.createDataFrame([(markdown_report(found, metadata),)], "value string")
        text.write.mode("overwrite").text(f"{base}/report_{mark}.md")
    violations.write.mode("overwrite").json(f"{base}/violations_{mark}.json")


def markdown_report(results: list, metadata: dict) -> str:
    """Metadata and result rows as Markdown."""
    lines = [f"# Data quality {metadata['timestamp']}", ""]
    lines += [f"- {k}: {v}" for k, v in metadata.items() if v not in (None, "")]
    lines += ["", "| stage | check | count | total | % | status |", "| --- | --- | --- | --- | --- | --- |"]
    for r in results:
        lines.append(f"| {r.stage} | {r.check} | {r['count']} | {r.total} | {r.percentage} | {r.status} |")
    return "\n".join(lines) + "\n"
