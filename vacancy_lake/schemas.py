"""Schemas of the raw, normalised and aggregate tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


LISTING = T.StructType(_strings("title", "company", "location", "salary", "experience", "url"))
DETAIL = T.StructType(
    _strings("id", "url", "normalized_url", "title", "company", "salary", "location", "experience", "deadline", "level")
    + [T.StructField("number_of_hires", T.IntegerType())]
    + _strings("job_type", "working_time", "location_detail", "crawled_at", "original_title")
)
TEXT = T.StructType(
    _strings("id", "url", "normalized_url", "title", "description", "requirements", "benefits", "crawled_at")
)
SECOND_LISTING = T.StructType(
    _strings("job_id", "source", "job_url", "job_title", "company_name", "location", "work_model")
    + [T.StructField("salary_hidden", T.BooleanType()), T.StructField("skills", T.ArrayType(T.StringType()))]
    + _strings("posted_text", "collected_at")
)
KEYWORDS = T.ArrayType(T.StringType(), False)
SILVER = T.StructType(
    _strings("job_id", "source", "job_url", "title", "company", "location_raw", "location_clean")
    + [T.StructField("salary_min", T.DoubleType()), T.StructField("salary_max", T.DoubleType())]
    + _strings("currency")
    + [T.StructField("is_negotiable", T.BooleanType())]
    + [T.StructField("exp_min", T.IntegerType()), T.StructField("exp_max", T.IntegerType())]
    + _strings("deadline", "level")
    + [T.StructField("number_of_hires", T.IntegerType())]
    + _strings("job_schedule_type", "working_time", "job_country", "work_mode")
    + [T.StructField("job_work_from_home", T.BooleanType())]
    + _strings("seniority_level", "normalized_role", "description", "requirements", "benefits")
    + [T.StructField("skills", KEYWORDS), T.StructField("domain_keywords", KEYWORDS)]
    + _strings("crawled_at")
)
