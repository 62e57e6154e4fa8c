"""Aggregate (Gold) tables and the read side's filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def metrics(silver: DataFrame) -> DataFrame:
    """total_jobs, avg_salary_max, top_role, top_location: one row.

    One scan: sums for the table, each role and each location (grouping sets), then the totals and
    the most frequent values (of equals the smallest) of those few rows.
    """
    names = {"normalized_role": "top_role", "location_clean": "top_location"}
    rows = silver.select("salary_max", *names)
    counted = rows.groupingSets([[], *[[c] for c in names]], *names).agg(
        F.grouping_id().alias("set"), F.count("*").alias("n"), F.avg("salary_max").alias("mean")
    )
    # A column's bit in the grouping id is set where the column is not grouped by.
    full = (1 << len(names)) - 1
    tops = []
    for k, (c, name) in enumerate(names.items()):
        own = (F.col("set") == full - (1 << (len(names) - 1 - k))) & F.col(c).isNotNull()
        tops.append(F.min_by(c, F.when(own, F.struct(-F.col("n"), F.col(c)))).alias(name))
    whole = F.col("set") == full
    return counted.agg(
        F.coalesce(F.max(F.when(whole, F.col("n"))), F.lit(0)).alias("total_jobs"),
        F.max(F.when(whole, F.col("mean"))).alias("avg_salary_max"),
        *tops,
    )


def means_by(df: DataFrame, keys: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Means by key; rows with a null key or a null mean are left out.  ``values``: column -> name."""
    kept = df.dropna(subset=list(keys))
    return kept.groupBy(*keys).agg(*[F.avg(c).alias(n) for c, n in values.items()]).dropna()


def salary_by_role(silver: DataFrame) -> DataFrame:
    return means_by(silver, ["normalized_role"], {"salary_min": "salary_min_mean", "salary_max": "salary_max_mean"})


def salary_by_seniority(silver: DataFrame) -> DataFrame:
    return means_by(silver, ["seniority_level"], {"salary_max": "salary_max_mean"})


def heatmap_salary(silver: DataFrame) -> DataFrame:
    """Mean upper salary by role and seniority, long."""
    return means_by(silver, ["normalized_role", "seniority_level"], {"salary_max": "salary_max_mean"})


def heatmap_wide(heatmap: DataFrame, levels: Sequence[str] | None = None) -> DataFrame:
    """One row per role, one column per seniority level."""
    return heatmap.groupBy("normalized_role").pivot("seniority_level", list(levels) if levels else None).agg(
        F.first("salary_max_mean")
    )


def value_counts(df: DataFrame, column: str, name: str, limit: int | None = None) -> DataFrame:
    """Counts of non-null values, the largest first, equals by value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(name)).agg(F.count("*").alias("count"))
    ordered = counted.orderBy(F.desc("count"), name)
    return ordered.limit(limit) if limit else ordered


def top_items(df: DataFrame, column: str, name: str, limit: int) -> DataFrame:
    """The most frequent items of an array column."""
    return value_counts(df.select(F.explode(column).alias("__item")), "__item", name, limit)


def top_skills(silver: DataFrame, limit: int = 20) -> DataFrame:
    return top_items(silver, "skills", "skill", limit)


def top_domains(silver: DataFrame, limit: int = 15) -> DataFrame:
    return top_items(silver, "domain_keywords", "domain", limit)


def top_items_by(df: DataFrame, key: str, column: str, limit: int) -> DataFrame:
    """The ``limit`` most frequent items of an array column for each key."""
    counted = (
        df.filter(F.col(key).isNotNull())
        .select(key, F.explode(column).alias(column))
        .groupBy(key, column)
        .agg(F.count("*").alias("count"))
    )
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("count"), column))
    return counted.withColumn("__r", rank).filter(F.col("__r") <= limit).drop("__r").orderBy(key, F.desc("count"), column)


def skills_by_role(silver: DataFrame, limit: int = 5) -> DataFrame:
    return top_items_by(silver, "normalized_role", "skills", limit)


def location_distribution(silver: DataFrame) -> DataFrame:
    return value_counts(silver, "location_clean", "location")


def work_mode_distribution(silver: DataFrame) -> DataFrame:
    return value_counts(silver, "work_mode", "work_mode")


#: Aggregate tables by name.
TABLES = {
    "metrics": metrics,
    "salary_by_role": salary_by_role,
    "salary_by_seniority": salary_by_seniority,
    "heatmap_salary": heatmap_salary,
    "top_skills": top_skills,
    "skills_by_role": skills_by_role,
    "location_distribution": location_distribution,
    "work_mode_distribution": work_mode_distribution,
    "top_domains": top_domains,
}


def build_gold(silver: DataFrame) -> dict[str, DataFrame]:
    """All aggregate tables, not computed yet."""
    return {name: make(silver) for name, make in TABLES.items()}


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values as text, in order."""
    return df.filter(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("option")).distinct().orderBy("option")


def selection(choices: dict[str, Sequence[str]]) -> Column:
    """True where every chosen column holds one of its chosen values; null never does."""
    out = F.lit(True)
    for column, values in choices.items():
        out &= F.coalesce(F.col(column).isin(*values), F.lit(False))
    return out


def selected_share(df: DataFrame, choices: dict[str, Sequence[str]]) -> DataFrame:
    """Selected and all rows, in one pass."""
    return df.agg(F.count_if(selection(choices)).alias("selected"), F.count("*").alias("total"))


def drill_down(df: DataFrame, choices: dict[str, Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """The selected rows themselves."""
    return df.filter(selection(choices)).select(*columns)
