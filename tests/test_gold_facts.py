"""A posting's facts: pairs only, single keys are summed from them."""

from pyspark.sql import functions as F

from vacancy_lake.operators import gold_parts


def test_a_posting_leaves_a_fact_for_each_pair_only(spark):
    df = spark.sql("SELECT 'r' normalized_role, 's' seniority_level, 'l' location_clean, 'w' work_mode, 1d salary_min, 2d salary_max, array('a', 'b') skills, array('d') domain_keywords")
    assert gold_parts.partials(df).agg(F.sum("n")).first()[0] == 6
