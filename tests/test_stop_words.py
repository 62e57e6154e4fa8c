"""Stop words are asked by hash, n-grams joined once."""

from pyspark.sql import functions as F

from vacancy_lake.operators import ngrams


def test_stop_words_are_asked_by_hash(spark):
    df = spark.createDataFrame([("the Job job data team Team",)], "t string").select(ngrams.tokens(F.col("t")).alias("w"))
    assert df.first().w == ["the", "job", "data", "team"]
    assert "array_contains" not in df._jdf.queryExecution().optimizedPlan().toString()
