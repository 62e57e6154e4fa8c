"""A stream target keeps every row and no key twice, whatever happens to its runs."""

import os
import shutil

import pytest

from vacancy_lake.streaming import ingest as stream

SCHEMA = "url string, o int"


@pytest.fixture()
def places(tmp_path):
    return [str(tmp_path / n) for n in ("landing", "target", "marks")]


def land(spark, landing, *rows):
    spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(landing)


def run(spark, landing, target, marks):
    records = stream.read_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema, "parquet")
    stream.ingest(records, target, marks, order=["o"]).awaitTermination()
    return {r.normalized_url: r.o for r in rows_of(spark, target)}


def rows_of(spark, target):
    rows = stream.read_target(spark, target).collect()
    assert len({r.normalized_url for r in rows}) == len(rows), "a key stands twice"
    return rows


def test_lost_checkpoint_and_emptied_landing(spark, places):
    landing, target, marks = places
    land(spark, landing, ("p/1?a", 1), ("p/2", 2), (None, 3), ("", 4))
    assert run(spark, *places) == {"p/1": 1, "p/2": 2}
    land(spark, landing, ("p/3", 5))
    assert run(spark, *places) == {"p/1": 1, "p/2": 2, "p/3": 5}
    shutil.rmtree(landing)
    land(spark, landing, ("p/4", 6), ("p/3?again", 0))
    found = run(spark, landing, target, marks + "-new")
    assert found == {"p/1": 1, "p/2": 2, "p/3": 5, "p/4": 6}
    log = stream.commits(spark, target).orderBy("seen", "rows").collect()
    assert sorted((r.batch, r.rows, r.seen) for r in log) == [(0, 1, 2), (0, 2, 4), (1, 1, 1)]
    assert len({r.run for r in log}) == 2


def test_lost_checkpoint_with_all_files_still_there(spark, places):
    landing, target, marks = places
    land(spark, landing, ("p/1", 1))
    land(spark, landing, ("p/2", 2))
    before = run(spark, *places)
    assert run(spark, landing, target, marks + "-new") == before == {"p/1": 1, "p/2": 2}


def test_a_batch_that_runs_twice(spark, places):
    target = places[1]
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("a", 0)], "k string, o int")
    write = stream.insert_new(target, "k", ["o"], run="r")
    for _ in range(2):
        write(batch, 0)
        assert sorted((r.k, r.o) for r in stream.read_target(spark, target).collect()) == [("a", 0), ("b", 2)]
    write(batch, 1)  # a later batch with the same rows adds none
    assert stream.read_target(spark, target).count() == 2
    stream.insert_new(target, "k", ["o"], run="other")(batch, 0)
    assert stream.read_target(spark, target).count() == 2


def test_a_batch_that_dies_half_way(spark, places, monkeypatch):
    target = places[1]
    write = stream.insert_new(target, "k", ["o"], run="r")
    write(spark.createDataFrame([("a", 1)], "k string, o int"), 0)
    batch = spark.createDataFrame([("a", 5), ("b", 2), ("c", 3)], "k string, o int")

    class Died(Exception):
        pass

    def dies(*_):
        raise Died

    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", dies)  # rows are written, the log is not
        with pytest.raises(Died):
            write(batch, 1)
    assert os.path.isdir(f"{target}/data/run=r/batch=1")
    assert [r.k for r in stream.read_target(spark, target).collect()] == ["a"]
    # Another run may come first; then the first one goes on with its batch.
    stream.insert_new(target, "k", ["o"], run="s")(spark.createDataFrame([("b", 9)], "k string, o int"), 0)
    write(batch, 1)
    assert sorted((r.k, r.o) for r in stream.read_target(spark, target).collect()) == [("a", 1), ("b", 9), ("c", 3)]


def test_targets_without_rows(spark, places):
    target = places[1]
    schema = spark.createDataFrame([], "k string, o int").schema
    assert stream.read_target(spark, target, schema).columns == ["k", "o", "run", "batch", "bucket"]
    write = stream.insert_new(target, "k", ["o"], run="r")
    write(spark.createDataFrame([], schema), 0)
    write(spark.createDataFrame([(None, 1), ("", 2)], schema), 1)
    assert stream.read_target(spark, target).columns[:2] == ["k", "o"] and stream.read_target(spark, target).count() == 0
    with pytest.raises(ValueError):
        stream.insert_new(target, "k", ["o"])(spark.createDataFrame([("a", 1)], schema), 0)
