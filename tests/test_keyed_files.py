"""Overlays that rewrite only touched slices equal the full join."""

import random

import pytest
from pyspark.sql import functions as F

from vacancy_lake.operators import ingest, keyed_files


def content(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_updates_equal_the_full_overlay(spark, tmp_path, kind):
    target, rng = str(tmp_path / "t"), random.Random(3)

    def keyed(ids, mark):
        return spark.createDataFrame([(i, f"{mark}{i}", None if i % 4 == 0 else mark) for i in ids], "k long, v string, w string").withColumn(
            "k", F.col("k").cast(kind)
        )

    want = keyed(range(0, 900, 3), "a")
    keyed_files.create_keyed(want, target, "k", rows_per_slice=20)
    assert keyed_files.slices(spark, target).count() >= 15
    for mark in "bcd":
        new = keyed(rng.sample(range(1200), 60), mark)
        new = new.drop("w").withColumn("x", F.lit(mark)) if mark == "c" else new
        full = ingest.overlay(want, new, "k")
        want = spark.createDataFrame(full.collect(), full.schema)
        done = keyed_files.overlay_keyed(new, target, "k", rows_per_slice=20)
        assert 0 < done["rewritten"] <= done["slices"]
        got = keyed_files.read_keyed(spark, target)
        assert content(got, want.columns) == content(want, want.columns)
        stats = keyed_files.slices(spark, target).agg(F.sum("rows"), F.max("rows")).first()
        assert stats[0] == want.count() and stats[1] <= 60  # slices that grow are split


def test_a_small_update_rewrites_few_slices_and_others_stay(spark, tmp_path):
    target = str(tmp_path / "t")
    keyed_files.create_keyed(spark.range(20_000).selectExpr("id AS k", "'old' AS v"), target, "k", rows_per_slice=500)
    before = {r.slice for r in keyed_files.slices(spark, target).collect()}
    done = keyed_files.overlay_keyed(spark.range(19_990, 20_010).selectExpr("id AS k", "'new' AS v"), target, "k", rows_per_slice=500)
    after = {r.slice for r in keyed_files.slices(spark, target).collect()}
    assert done["rewritten"] == 1 and len(before) >= 35 and len(before - after) == 1
    got = keyed_files.read_keyed(spark, target)
    assert got.count() == 20_010 and got.filter("v = 'new'").count() == 20
    assert keyed_files.read_keyed(spark, target, version=1).filter("v = 'new'").count() == 0


def test_a_job_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    keyed_files.create_keyed(spark.range(100).selectExpr("id AS k", "'old' AS v"), target, "k", rows_per_slice=10)
    new = spark.range(50, 60).selectExpr("id AS k", "'new' AS v")

    def dies(*_):
        raise RuntimeError

    with monkeypatch.context() as m:
        m.setattr(keyed_files, "_manifest", dies)  # the slices are written, the manifest is not
        with pytest.raises(RuntimeError):
            keyed_files.overlay_keyed(new, target, "k", rows_per_slice=10)
    assert keyed_files.read_keyed(spark, target).filter("v = 'new'").count() == 0
    keyed_files.overlay_keyed(new, target, "k", rows_per_slice=10)
    got = keyed_files.read_keyed(spark, target)
    assert got.count() == 100 and got.filter("v = 'new'").count() == 10


def test_empty_tables_and_rows_without_key(spark, tmp_path):
    target, schema = str(tmp_path / "t"), "k string, v string"
    keyed_files.create_keyed(spark.createDataFrame([(None, "x"), ("", "y")], schema), target, "k")
    assert keyed_files.read_keyed(spark, target).columns == ["k", "v"] and keyed_files.read_keyed(spark, target).count() == 0
    assert keyed_files.overlay_keyed(spark.createDataFrame([(None, "x")], schema), target, "k") == {"slices": 0, "rewritten": 0}
    keyed_files.overlay_keyed(spark.createDataFrame([("b", "1"), (None, "x"), ("a", None)], schema), target, "k")
    assert content(keyed_files.read_keyed(spark, target), ["k", "v"]) == ["Row(k='a', v=None)", "Row(k='b', v='1')"]


def test_tasks_grow_with_rows_not_with_slices(spark, tmp_path):
    """2,000 rows as 100 slices are written by as many tasks as a shuffle has; no rest is a slice of its own."""
    target = str(tmp_path / "t")
    keyed_files.create_keyed(spark.range(2000).selectExpr("id AS k", "'old' AS v"), target, "k", rows_per_slice=20)
    found = keyed_files.slices(spark, target).collect()
    assert len({r.slice.split("-")[2] for r in found}) <= 4
    assert 60 <= len(found) <= 105 and all(10 <= r.rows < 30 for r in found)
    keyed_files.overlay_keyed(spark.range(0, 2000, 3).selectExpr("id AS k", "'new' AS v"), target, "k", rows_per_slice=20)
    assert keyed_files.read_keyed(spark, target).count() == 2000
