"""Pending rows by a bitmap of done keys, and landing in files by size."""

import pytest
from pyspark.sql import functions as F

from vacancy_lake.operators import ingest
from vacancy_lake.sources import landing


def content(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("kind", ["long", "string"])
def test_bitmap_equals_the_anti_join(spark, kind):
    listed = spark.range(4000).select(F.col("id").cast(kind).alias("k"), (F.col("id") % 7).alias("__v"))
    listed = listed.unionByName(listed.filter("k % 5 = 0")).unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) AS k, 1L AS __v"))
    done = spark.range(1000, 9000, 3).select(F.col("id").cast(kind).alias("k"), F.lit(1).alias("__v"))
    done = done.unionByName(done).unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) AS k, 1 AS __v"))
    want = content(ingest.pending(listed, done, "k"))
    for options in ({}, {"bits_per_key": 1}, {"most_bytes": 0}):
        got = ingest.pending_by_bitmap(listed, done, "k", **options)
        assert got.columns == ingest.pending(listed, done, "k").columns
        assert content(got) == want
    empty = done.limit(0)
    assert content(ingest.pending_by_bitmap(listed, empty, "k")) == content(listed)
    assert content(ingest.pending_by_bitmap(listed.limit(0), done, "k")) == []


def test_few_rows_go_to_the_exact_join(spark):
    listed, done = spark.range(200_000).toDF("k"), spark.range(200_000, 300_000).toDF("k")
    bits = -(-100_000 * 16 // ingest.BITMAP_BITS) * ingest.BITMAP_BITS
    marked = ingest.maybe_done(listed, done, "k", bits)
    assert 0.04 < marked.filter("__maybe").count() / 200_000 < 0.075  # one of 16
    assert ingest.maybe_done(done, done, "k", bits).filter("NOT __maybe").count() == 0


def files(spark, path):
    read = landing.read_landing(spark, path).groupBy("run", "crawl_date", "role").agg(F.count_distinct("_metadata.file_path").alias("f"), F.count("*").alias("n"))
    return {(r.run, r.crawl_date, r.role): (r.f, r.n) for r in read.collect()}


@pytest.mark.parametrize("kind", ["json", "parquet"])
def test_files_by_size_and_runs_once(spark, tmp_path, kind):
    path = str(tmp_path / "l")
    df = spark.range(0, 4040, 1, 12).select(F.col("id").alias("k"), F.lit("x").alias("run_note"))
    at = F.lit("2024-01-01")
    role = F.when(F.col("k") < 4000, "hot").when(F.col("k") < 4030, F.concat(F.lit("r"), (F.col("k") % 3).cast("string")))
    assert landing.land(df, path, at, role, "a", kind, rows_per_file=500)
    assert not landing.land(df, path, at, role, "a", kind, rows_per_file=500)
    got = files(spark, path)
    assert got[("a", "2024-01-01", "hot")][1] == 4000 and 8 <= got[("a", "2024-01-01", "hot")][0] <= 16
    assert {k[2]: v for k, v in got.items() if k[2] != "hot"} == {"r0": (1, 10), "r1": (1, 10), "r2": (1, 10), None: (1, 10)}
    assert landing.land(df.withColumn("more", F.lit(1)), path, at, role, "b", kind)
    back = landing.read_landing(spark, path)
    assert back.count() == 8080 and back.filter("more = 1").count() == 4040


def test_equal_rows_all_stay_and_a_dying_run_is_not_read(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "l"), spark.range(1000).select(F.lit("same").alias("t"))
    assert landing.read_landing(spark, path).count() == 0

    def dies(*_):
        raise RuntimeError

    with monkeypatch.context() as m:
        m.setattr(landing, "_commit", dies)
        with pytest.raises(RuntimeError):
            landing.land(df, path, F.lit("d"), F.lit("r"), "a", "parquet", rows_per_file=100)
    assert landing.read_landing(spark, path).count() == 0
    assert landing.land(df, path, F.lit("d"), F.lit("r"), "a", "parquet", rows_per_file=100)
    assert files(spark, path) == {("a", "d", "r"): (10, 1000)}
    assert landing.land(df.limit(0), path, F.lit("d"), F.lit("r"), "b", "parquet") and landing.read_landing(spark, path).count() == 1000
