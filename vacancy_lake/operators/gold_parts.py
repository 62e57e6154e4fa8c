"""Gold tables kept up to date: partial aggregates of each Silver batch, from which all nine tables come.

A batch is read once, in one aggregation, and leaves as many rows as it has distinct pairs of role and seniority, pairs
of role and skill, locations, work modes and domains; single roles, seniorities and skills are sums of the pairs.  A store is a folder ``parts/<id>`` for each batch and a log with a
row for each batch, written last: parts of a job that died are never read, and a batch given again takes the place
of its earlier version, so a repeated job counts nothing twice.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Partial aggregates: rows of a key, sums of both salary bounds and how many are given.
PARTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("kind", "k1", "k2")]
    + [T.StructField(n, T.LongType()) for n in ("n", "min_n", "max_n")]
    + [T.StructField(n, T.DoubleType()) for n in ("min_sum", "max_sum")]
)
LOG = T.StructType([T.StructField("batch", T.StringType()), T.StructField("part", T.StringType()), T.StructField("at", T.TimestampType())])
#: Kinds of keys that a batch leaves: columns of Silver.
KEYS = {
    "role_seniority": ("normalized_role", "seniority_level"),
    "location": ("location_clean",),
    "work_mode": ("work_mode",),
}
#: Kinds whose partial aggregates are those of a finer kind, added up: kind and kept keys of that.
SUMS = {
    "all": ("role_seniority", ()),
    "role": ("role_seniority", ("k1",)),
    "seniority": ("role_seniority", ("k2",)),
    "skill": ("role_skill", ("k2",)),
}


def partials(silver: DataFrame) -> DataFrame:
    """Partial aggregates of a batch: one scan, one aggregation, whose partial values combine before the shuffle.

    Keys may be null; a null list has no items, a null item is an item of its own.
    """
    none, no_value = F.lit(None).cast("string"), F.lit(None).cast("double")

    def fact(kind: str, k1: Column = none, k2: Column = none, low: Column = no_value, high: Column = no_value) -> Column:
        return F.struct(F.lit(kind).alias("kind"), k1.alias("k1"), k2.alias("k2"), low.alias("low"), high.alias("high"))

    def items(kind: str, column: str, *keys: Column) -> Column:
        listed = F.coalesce(F.col(column), F.array().cast("array<string>"))
        return F.transform(listed, lambda item: fact(kind, *keys, item))

    salaries = {"low": F.col("salary_min").cast("double"), "high": F.col("salary_max").cast("double")}
    rows = F.array(*[fact(kind, *map(F.col, names), **salaries) for kind, names in KEYS.items()])
    lists = [items("role_skill", "skills", F.col("normalized_role")), items("domain", "domain_keywords")]
    return (
        silver.select(F.inline(F.concat(rows, *lists)))
        .groupBy("kind", "k1", "k2")
        .agg(
            F.count("*").alias("n"),
            F.count("low").alias("min_n"),
            F.count("high").alias("max_n"),
            F.sum("low").alias("min_sum"),
            F.sum("high").alias("max_sum"),
        )
    )


def merged(parts: DataFrame) -> DataFrame:
    """Partial aggregates of several batches as those of one, with the kinds that are sums of others."""
    none = F.lit(None).cast("string")
    # A sum that a batch's part holds itself, as older parts do, is not added again.
    held = ~F.col("kind").isin(list(SUMS))
    copies = [F.struct("kind", "k1", "k2")]
    for kind, (fine, keys) in SUMS.items():
        k1, k2 = ([F.col(k) for k in keys] + [none, none])[:2]
        copies.append(F.when(F.col("kind") == fine, F.struct(F.lit(kind).alias("kind"), k1.alias("k1"), k2.alias("k2"))))
    numbers = PARTS.names[3:]
    rows = parts.filter(held).select(F.inline(F.array_compact(F.array(*copies))), *numbers)
    return rows.groupBy("kind", "k1", "k2").agg(*[F.sum(c).alias(c) for c in numbers])


def tables(parts: DataFrame, skills: int = 20, domains: int = 15, per_role: int = 5) -> dict[str, DataFrame]:
    """All nine Gold tables, with the rows that ``gold.build_gold`` makes of the whole Silver table."""
    total = merged(parts)
    low, high = F.col("min_sum") / F.col("min_n"), F.col("max_sum") / F.col("max_n")

    def of(kind: str) -> DataFrame:
        return total.filter(F.col("kind") == kind)

    def means(kind: str, keys: tuple[str, ...], low_too: bool = False) -> DataFrame:
        named = [F.col(f"k{i + 1}").alias(k) for i, k in enumerate(keys)]
        values = [low.alias("salary_min_mean")] if low_too else []
        return of(kind).select(*named, *values, high.alias("salary_max_mean")).dropna()

    def counts(kind: str, name: str, limit: int | None = None) -> DataFrame:
        ordered = of(kind).filter(F.col("k1").isNotNull()).select(F.col("k1").alias(name), F.col("n").alias("count")).orderBy(F.desc("count"), name)
        return ordered.limit(limit) if limit else ordered

    def top(kind: str) -> Column:
        return F.min_by("k1", F.when((F.col("kind") == kind) & F.col("k1").isNotNull(), F.struct(-F.col("n"), F.col("k1"))))

    whole = F.col("kind") == "all"
    rank = F.row_number().over(Window.partitionBy("k1").orderBy(F.desc("n"), "k2"))
    by_role = of("role_skill").filter(F.col("k1").isNotNull()).withColumn("__r", rank).filter(F.col("__r") <= per_role)
    return {
        "metrics": total.agg(
            F.coalesce(F.max(F.when(whole, F.col("n"))), F.lit(0)).alias("total_jobs"),
            F.max(F.when(whole, high)).alias("avg_salary_max"),
            top("role").alias("top_role"),
            top("location").alias("top_location"),
        ),
        "salary_by_role": means("role", ("normalized_role",), low_too=True),
        "salary_by_seniority": means("seniority", ("seniority_level",)),
        "heatmap_salary": means("role_seniority", ("normalized_role", "seniority_level")),
        "top_skills": counts("skill", "skill", skills),
        "skills_by_role": by_role.select(F.col("k1").alias("normalized_role"), F.col("k2").alias("skills"), F.col("n").alias("count")).orderBy(
            "normalized_role", F.desc("count"), "skills"
        ),
        "location_distribution": counts("location", "location"),
        "work_mode_distribution": counts("work_mode", "work_mode"),
        "top_domains": counts("domain", "domain", domains),
    }


def log(spark: SparkSession, store: str) -> DataFrame:
    """batch, part, at: the newest version of each batch.  A new store has none."""
    try:
        rows = spark.read.schema(LOG).json(f"{store}/_log/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)
    newest = F.max(F.struct("at", "part")).alias("v")
    return rows.groupBy("batch").agg(newest).select("batch", "v.part", "v.at")


def put_batch(silver: DataFrame, store: str, batch: str) -> None:
    """Adds a batch's partial aggregates, or replaces those that an earlier run left under ``batch``."""
    spark, part = silver.sparkSession, uuid.uuid4().hex
    # Few rows: the distinct keys of a batch.
    partials(silver).coalesce(1).write.parquet(f"{store}/parts/{part}")
    _commit(spark, store, batch, part)


def _commit(spark: SparkSession, store: str, batch: str, part: str) -> None:
    row = spark.range(1).select(F.lit(batch).alias("batch"), F.lit(part).alias("part"), F.current_timestamp().alias("at"))
    row.write.json(f"{store}/_log/{part}")


def read_parts(spark: SparkSession, store: str) -> DataFrame:
    """Partial aggregates of all committed batches."""
    # One row a batch, as many as there were loads.
    parts = [r.part for r in log(spark, store).collect()]
    if not parts:
        return spark.createDataFrame([], PARTS)
    return spark.read.schema(PARTS).parquet(*[f"{store}/parts/{p}" for p in parts])


def read_tables(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """The nine Gold tables of all committed batches; no Silver row is read."""
    return tables(read_parts(spark, store))
