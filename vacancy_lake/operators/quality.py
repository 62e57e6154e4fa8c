"""Data quality: five stages of checks.  Those that only count rows share one aggregation over the table.

A stage gives one row per check: stage, check, count (of violations, or of good values), total,
percentage, status.  A check whose columns are missing counts nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import vocabulary as V
from ..functions.text import is_blank

OK, WARNING, ERROR = "OK", "WARNING", "ERROR"
RESULT = ["stage", "check", "count", "total", "percentage", "status"]


def _long(df: DataFrame, stage: str, row: dict[str, Column], total: Column) -> DataFrame:
    """A row per check from one row of counts; no results if ``total`` is 0."""
    checks = [F.struct(F.lit(n).alias("check"), c.cast("long").alias("count")) for n, c in row.items()]
    long = df.filter(total > 0)
    return long.select(F.lit(stage).alias("stage"), F.inline(F.array(*checks)), total.alias("total"))


def _finished(df: DataFrame, status: Column) -> DataFrame:
    percentage = F.round(F.col("count") * 100.0 / F.col("total"), 2)
    return df.withColumn("percentage", percentage).withColumn("status", status).select(*RESULT)


@dataclass(frozen=True)
class Checks:
    """A stage whose checks count rows: counts for a table's columns, status by count and total."""

    stage: str
    counts: Callable[[DataFrame], dict[str, Column]]
    status: Column

    def counted(self, df: DataFrame) -> list[Column]:
        return [c.alias(f"{self.stage}.{n}") for n, c in self.counts(df).items()]

    def of(self, row: DataFrame, df: DataFrame) -> DataFrame:
        """Results from a row that holds ``counted`` and the total."""
        checks = {n: F.col(f"`{self.stage}.{n}`") for n in self.counts(df)}
        return _finished(_long(row, self.stage, checks, F.col("total")), self.status)

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.of(df.agg(*self.counted(df), F.count("*").alias("total")), df)


# --- completeness -------------------------------------------------------------------------------


def present(df: DataFrame, column: str) -> Column:
    """Good values of a column: not blank if text, not empty if a list, else not null."""
    if column not in df.columns:
        return F.lit(False)
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        return F.size(column) > 0
    if isinstance(kind, T.StringType) and column == "skills":
        return F.col(column).isNotNull() & ~F.col(column).isin("", "[]", "None")
    if isinstance(kind, T.StringType) and column != "deadline":
        return ~is_blank(F.col(column))
    return F.col(column).isNotNull()


FIELDS = ["title", "company", "location_clean", "normalized_role", "salary_min", "salary_max", "skills", "deadline"]
LOWER_ERROR = {"salary_min": 0.25, "salary_max": 0.25}


def completeness_checks(
    fields: Sequence[str] = FIELDS,
    warn: float = 0.95,
    error: float = 0.80,
    overrides: dict[str, float] = LOWER_ERROR,
) -> Checks:
    """Share of good values per field against a warning and an error threshold."""
    share = F.col("count") / F.col("total")
    least = F.coalesce(*[F.when(F.col("check") == f, F.lit(x)) for f, x in overrides.items()], F.lit(error))
    status = F.when(share >= warn, OK).when(share >= least, WARNING).otherwise(ERROR)
    return Checks("completeness", lambda df: {f: F.count_if(present(df, f)) for f in fields}, status)


def completeness(df: DataFrame, *args, **kwargs) -> DataFrame:
    """Results of ``completeness_checks``."""
    return completeness_checks(*args, **kwargs)(df)


# --- rules: validity and accuracy ---------------------------------------------------------------


def above(low: str, high: str) -> Column:
    return F.col(low) > F.col(high)


def outside(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def either_over(columns: Sequence[str], limit: float) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > limit, F.lit(False)) for c in columns])


#: name -> (columns it needs, violation)
Rules = dict[str, tuple[Sequence[str], Column]]


def validity_rules() -> Rules:
    return {
        "salary_min_le_max": (["salary_min", "salary_max"], above("salary_min", "salary_max")),
        "exp_min_le_max": (["exp_min", "exp_max"], above("exp_min", "exp_max")),
        "valid_currency": (["currency"], outside("currency", ["VND", "USD"])),
        "valid_work_mode": (["work_mode"], outside("work_mode", ["Onsite", "Hybrid", "Remote"])),
        "valid_seniority": (
            ["seniority_level"],
            outside("seniority_level", ["Junior", "Middle", "Senior", "Lead", "Unknown"]),
        ),
        "valid_deadline": (
            ["deadline"],
            F.col("deadline").isNotNull() & F.try_to_timestamp("deadline", F.lit("yyyy-MM-dd")).isNull(),
        ),
    }


def accuracy_rules(vnd: float = 500.0, usd: float = 20000.0, years: int = 15) -> Rules:
    salary = ["salary_min", "salary_max"]
    known = F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull()
    return {
        "accurate_negotiable_salary": (["is_negotiable", *salary], F.col("is_negotiable") & known),
        "accurate_missing_salary": (["is_negotiable", *salary], ~F.col("is_negotiable") & ~known),
        "outlier_salary_vnd": (["currency", *salary], (F.col("currency") == "VND") & either_over(salary, vnd)),
        "outlier_salary_usd": (["currency", *salary], (F.col("currency") == "USD") & either_over(salary, usd)),
        "outlier_experience": (["exp_min", "exp_max"], either_over(["exp_min", "exp_max"], years)),
    }


def _violations(df: DataFrame, rules: Rules) -> dict[str, Column]:
    return {
        n: F.count_if(c) if set(need) <= set(df.columns) else F.count_if(F.lit(False)) for n, (need, c) in rules.items()
    }


def validity_checks(warn: int = 5, error: int = 15) -> Checks:
    """Rows with impossible values; status by number of rows."""
    n = F.col("count")
    status = F.when(n <= warn, OK).when(n <= error, WARNING).otherwise(ERROR)
    return Checks("validity", lambda df: _violations(df, validity_rules()), status)


def validity(df: DataFrame, *args, **kwargs) -> DataFrame:
    """Results of ``validity_checks``."""
    return validity_checks(*args, **kwargs)(df)


def accuracy_checks(vnd: float = 500.0, usd: float = 20000.0, years: int = 15) -> Checks:
    """Rows with contradictions and outliers; any of them is a warning."""
    status = F.when(F.col("count") == 0, OK).otherwise(WARNING)
    return Checks("accuracy", lambda df: _violations(df, accuracy_rules(vnd, usd, years)), status)


def accuracy(df: DataFrame, *args, **kwargs) -> DataFrame:
    """Results of ``accuracy_checks``."""
    return accuracy_checks(*args, **kwargs)(df)


# --- uniqueness ---------------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """key, n for each non-null key with more than one row."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def role_mismatch(role: Column, title: Column, words: dict[str, list[str]] = V.ROLE_WORDS) -> Column:
    """Why a title does not go with its role: unknown_role, no_keyword_match, or null."""
    lookup = F.create_map(*[x for r, ws in words.items() for x in (F.lit(r), F.array(*map(F.lit, ws)))])
    expected = F.try_element_at(lookup, role)
    low = F.lower(title)
    return F.when(role.isNull() | title.isNull(), None).when(expected.isNull(), "unknown_role").when(
        ~F.exists(expected, lambda w: F.contains(low, w)), "no_keyword_match"
    )


def uniqueness(df: DataFrame, warn_duplicates: int = 2, warn_consistency: int = 5) -> DataFrame:
    """Repeated job URLs (distinct ones), and titles that do not go with their role: one pass, one
    shuffle of partial counts by URL."""
    url = F.col("job_url") if "job_url" in df.columns else F.lit(None).cast("string")
    wrong = F.lit(False)
    if {"job_url", "title", "normalized_role"} <= set(df.columns):
        wrong = role_mismatch(F.col("normalized_role"), F.col("title")).isNotNull()
    by_url = df.select(url.alias("url"), wrong.alias("wrong")).groupBy("url").agg(
        F.count("*").alias("n"), F.count_if("wrong").alias("wrong")
    )
    row = by_url.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count_if(F.col("url").isNotNull() & (F.col("n") > 1)).alias("duplicate_job_url"),
        F.sum("wrong").alias("role_title_consistency"),
    )
    checks = {c: F.col(c) for c in ("duplicate_job_url", "role_title_consistency")}
    limit = F.when(F.col("check") == "duplicate_job_url", warn_duplicates).otherwise(warn_consistency)
    return _finished(_long(row, "uniqueness", checks, F.col("total")), F.when(F.col("count") > limit, WARNING).otherwise(OK))


# --- timeliness ---------------------------------------------------------------------------------


def timeliness_checks(as_of: Column, days: int = 30, warn_share: float = 20.0, column: str = "crawled_at") -> Checks:
    """Rows crawled over ``days`` before ``as_of``; unknown times are not stale but count in the total."""

    def counts(df: DataFrame) -> dict[str, Column]:
        if column not in df.columns:
            return {"stale_records": F.count_if(F.lit(False))}
        ts = F.col(column)
        if isinstance(df.schema[column].dataType, T.StringType):
            ts = F.try_to_timestamp(ts)
        return {"stale_records": F.count_if(ts < as_of - F.expr(f"INTERVAL {days} DAYS"))}

    share = F.col("count") * 100.0 / F.col("total")
    return Checks("timeliness", counts, F.when(share > warn_share, WARNING).otherwise(OK))


def timeliness(df: DataFrame, *args, **kwargs) -> DataFrame:
    """Results of ``timeliness_checks``."""
    return timeliness_checks(*args, **kwargs)(df)


# --- runner -------------------------------------------------------------------------------------

Stage = Callable[[DataFrame], DataFrame]


def stages(as_of: Column) -> dict[str, Stage]:
    """The registry of stages, with default thresholds."""
    return {
        "completeness": completeness_checks(),
        "validity": validity_checks(),
        "accuracy": accuracy_checks(),
        "uniqueness": uniqueness,
        "timeliness": timeliness_checks(as_of),
    }


RESULT_SCHEMA = "stage string, check string, count long, total long, percentage double, status string"


def run_stages(df: DataFrame, registry: dict[str, Stage], names: Sequence[str] | None = None) -> DataFrame:
    """Results of the named stages (None: all).  Unknown names are left out; ValueError if none is left.

    The stages run here: a few rows each.  Those that only count rows run in one pass; if it fails,
    each runs alone.  A stage that fails, planned or running, gives a row of status ERROR, and the
    others still have their results.
    """
    chosen = [n for n in (registry if names is None else names) if n in registry]
    if not chosen:
        raise ValueError("no known stage is named")
    rows: dict[str, list] = {}
    shared = [n for n in chosen if isinstance(registry[n], Checks)]
    if len(shared) > 1:
        try:
            counts = [c for n in shared for c in registry[n].counted(df)]
            counted = df.agg(*counts, F.count("*").alias("total"))
            row = df.sparkSession.createDataFrame([counted.first()], counted.schema)
            rows = {n: [tuple(r) for r in registry[n].of(row, df).collect()] for n in shared}
        except Exception:  # noqa: BLE001  which stage it was shows when each runs alone
            rows = {}
    for name in chosen:
        if name in rows:
            continue
        try:
            rows[name] = [tuple(r) for r in registry[name](df).select(*RESULT).collect()]
        except Exception as e:  # noqa: BLE001  a stage's failure is a result
            rows[name] = [(name, f"failed: {type(e).__name__}", 0, 0, None, ERROR)]
    return df.sparkSession.createDataFrame([r for name in chosen for r in rows[name]], RESULT_SCHEMA)


def gate(results: DataFrame) -> DataFrame:
    """exit_code: 1 if any result is an error; 0 for no results."""
    return results.agg(F.coalesce(F.max((F.col("status") == ERROR).cast("int")), F.lit(0)).alias("exit_code"))


def summary(results: DataFrame) -> DataFrame:
    """Checks and statuses per stage."""
    return results.groupBy("stage").agg(
        F.count("*").alias("checks"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in (OK, WARNING, ERROR)],
    )


def violations(df: DataFrame, rules: Rules, columns: Sequence[str], key: str = "job_url") -> DataFrame:
    """check, key, detail (JSON of ``columns``) of every violating row, one scan for all rules."""
    usable = {n: c for n, (need, c) in rules.items() if set(need) <= set(df.columns)}
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in usable.items()]))
    detail = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(F.explode(broken).alias("check"), key, detail.alias("detail"))


def violation_sample(rows: DataFrame, limit: int = 10, key: str = "job_url") -> DataFrame:
    """The first ``limit`` violations of each check, and how many more there are.

    Ranks beyond the limit go before the shuffle, and counts are combined before theirs, so no task
    gathers all violations of a check.
    """
    first = F.row_number().over(Window.partitionBy("check").orderBy(key, "detail"))
    top = rows.withColumn("rank", first).filter(F.col("rank") <= limit)
    counts = rows.groupBy("check").agg(F.greatest(F.count("*") - limit, F.lit(0)).alias("more"))
    return top.join(counts, "check").select(*rows.columns, "rank", "more")
