"""Merged postings to the normalised (Silver) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from .. import vocabulary as V
from ..functions import normalise as N
from ..functions.text import given, join_given, keywords_in, phrases_in


#: Why a row is left out.
BAD_SALARY = "salary: number token without a digit"
REASONS = (BAD_SALARY,)


def normalised(merged: DataFrame, country: str = "Vietnam", default_source: str = "TopCV") -> DataFrame:
    """SILVER columns and ``reject_reason`` (null for a good row) of merged postings.

    Narrow: no join, no shuffle.
    """
    missing = [n for n in ("normalized_url", "level", "number_of_hires", "benefits", "source") if n not in merged.columns]
    df = merged.withColumns({n: F.lit(None).cast("int" if n == "number_of_hires" else "string") for n in missing})
    # What several columns below take from: put out by a generator, through which the optimizer moves
    # no expression, so that each is computed once per row.
    shared = F.struct(
        N.parse_salary(F.col("salary")).alias("__salary"),
        N.parse_experience(F.col("experience")).alias("__exp"),
        N.derive_work_mode(F.col("working_time"), F.col("description"), F.col("requirements")).alias("__mode"),
        join_given(F.col("title"), F.col("description"), F.col("requirements")).alias("__text"),
        N.normalize_role(F.col("title")).alias("__role"),
    )
    df = df.select("*", F.inline(F.array(shared)))
    columns = {
        "job_id": F.col("id"),
        "source": F.coalesce("source", F.lit(default_source)),
        "job_url": F.when(given(F.col("url")), F.col("url")).otherwise(F.col("normalized_url")),
        "title": F.col("title"),
        "company": F.col("company"),
        "location_raw": F.col("location"),
        "location_clean": N.clean_location(F.col("location")),
        "salary_min": F.col("__salary.salary_min"),
        "salary_max": F.col("__salary.salary_max"),
        "currency": F.col("__salary.currency"),
        "is_negotiable": F.col("__salary.is_negotiable"),
        "exp_min": F.col("__exp.exp_min"),
        "exp_max": F.col("__exp.exp_max"),
        "deadline": F.col("deadline"),
        "level": F.col("level"),
        "number_of_hires": F.col("number_of_hires"),
        "job_schedule_type": N.schedule_type(F.col("job_type")),
        "working_time": F.col("working_time"),
        "job_country": F.lit(country),
        "work_mode": F.col("__mode.work_mode"),
        "job_work_from_home": F.col("__mode.job_work_from_home"),
        "seniority_level": N.derive_seniority(F.col("title"), F.col("__exp.exp_min")),
        "normalized_role": F.col("__role"),
        "description": F.col("description"),
        "requirements": F.col("requirements"),
        "benefits": F.col("benefits"),
        "skills": keywords_in(F.col("__text"), [w for w in V.SKILLS if w not in set(V.DOMAINS)]),
        "domain_keywords": phrases_in(F.col("__text"), V.DOMAINS),
        "crawled_at": F.col("crawled_at"),
    }
    reason = F.when(F.col("__salary.bad_number"), F.lit(BAD_SALARY))
    return df.select(*[columns[f.name].alias(f.name) for f in schemas.SILVER], reason.alias("reject_reason"))


def to_silver(merged: DataFrame) -> DataFrame:
    """Good rows."""
    return normalised(merged).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(merged: DataFrame) -> DataFrame:
    """Rows that are left out: id, url, reason."""
    bad = normalised(merged).filter(F.col("reject_reason").isNotNull())
    return bad.select("job_id", "job_url", "reject_reason")


def typed_record(df: DataFrame) -> DataFrame:
    """Records read from text: ``crawled_at`` as timestamp, ``skills`` text as a list; unknown columns dropped."""
    known = [c for c in schemas.SILVER.names if c in df.columns]
    out = df.select(*known)
    if "crawled_at" in known and dict(out.dtypes)["crawled_at"] == "string":
        out = out.withColumn("crawled_at", N.iso_to_timestamp(F.col("crawled_at")))
    if "skills" in known and dict(out.dtypes)["skills"] == "string":
        out = out.withColumn("skills", F.coalesce(N.split_list(F.col("skills")), F.array().cast("array<string>")))
    return out
