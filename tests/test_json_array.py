"""Array files cut into small splits give the rows that Spark gives for whole files."""

import json
import random

import pytest
from pyspark.sql import types as T

from vacancy_lake.sources import io, json_array

SCHEMA = T.StructType(
    [
        T.StructField("a", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("o", T.StructType([T.StructField("x", T.ArrayType(T.StringType()))])),
    ]
)
PARTS = ["{", "}", "[", "]", '"', "\\", "é", "😀", ",", "a", " ", "\n", '\\"', "}{", "}]"]


@pytest.fixture(params=[60, 1500])
def small_splits(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{k}")


def odd(rng):
    return "".join(rng.choice(PARTS) for _ in range(rng.randrange(25)))


def record(rng):
    full = {"a": odd(rng), "n": rng.randrange(9), "o": {"x": [odd(rng) for _ in range(rng.randrange(3))]}, "more": {"y": [{}]}}
    return {k: v for k, v in full.items() if rng.random() < 0.85}


def whole(spark, path):
    bad = T.StructType([*SCHEMA.fields, T.StructField("_c", T.StringType())])
    df = spark.read.schema(bad).option("multiLine", True).option("columnNameOfCorruptRecord", "_c").json(path)
    return sorted(map(str, df.cache().filter("_c IS NULL").select(*SCHEMA.names).collect()))


def split(spark, path):
    return sorted(map(str, json_array.read_array(spark, path, SCHEMA).collect()))


def test_odd_strings_at_every_cut(spark, tmp_path, small_splits):
    rng = random.Random(7)
    for k in range(8):
        rows = [record(rng) for _ in range(rng.randrange(1, 9))]
        text = json.dumps(rows, ensure_ascii=k % 2 == 0, indent=[None, 1][k % 3 == 0])
        if k % 4 == 3:  # malformed somewhere
            at = rng.randrange(len(text))
            text = text[:at] + text[at + 1 :]
        (tmp_path / f"f{k}.json").write_text(text if k % 5 else f" \n{text}\n ")
    (tmp_path / "one.json").write_text(json.dumps({"a": "alone }", "n": 3}))
    (tmp_path / "none.json").write_text("[ ]")
    (tmp_path / "empty.json").write_text("")
    got = split(spark, str(tmp_path))
    assert got == whole(spark, str(tmp_path)) and len(got) > 15


@pytest.mark.parametrize(
    "text",
    ['[{"a": "x"}, {"a": "y"}', '[{"a": "x"} {"a": "y"}]', '[{"a": "x"},]', '[{"a": "x"}] tail', '[{"a": "x}]', '{"a": "x"', "no json", '[{"a": [1}]', '[, {"a": "x"}]'],
)
def test_a_malformed_file_gives_no_rows(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"a": "kept"}]')
    assert [r.a for r in json_array.read_array(spark, str(tmp_path), SCHEMA).collect()] == ["kept"]


def test_a_record_over_many_splits_and_many_tasks(spark, tmp_path):
    rows = [{"a": "short"}, {"a": "long } " * 3000}, *[{"n": k} for k in range(500)]]
    path = tmp_path / "x.json"
    path.write_text(json.dumps(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert json_array._chunks(spark, str(path)).rdd.getNumPartitions() > 10
        assert split(spark, str(path)) == whole(spark, str(path))
        assert io.read_records(spark, str(path), SCHEMA, whole_file_bytes=0).count() == len(rows)
    finally:
        for k in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{k}")
    assert io.read_records(spark, str(path), SCHEMA).count() == len(rows)
    assert json_array.read_array(spark, str(tmp_path / "missing"), SCHEMA).count() == 0


def test_records_can_be_counted(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"n": 1}\n{"a": "x"}\nno json\n')
    (tmp_path / "array.json").write_text('[{"n": 1}, {"o": {"x": []}}]')
    assert io.read_records(spark, str(tmp_path / "lines.json"), SCHEMA, multi_line=False).count() == 2
    assert io.read_records(spark, str(tmp_path / "array.json"), SCHEMA).count() == 2
