"""The Silver step: guards before patterns change no result, and no query makes the table twice."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vacancy_lake import vocabulary as V
from vacancy_lake.functions import normalise as N
from vacancy_lake.functions import text as X
from vacancy_lake.sources import io


def test_strip_takes_all_unicode_white_space_and_nothing_else(spark):
    marks = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c + "a " + c + "b" + c,) for c in marks], "t string")
    old = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    assert df.filter(X.strip(F.col("t")) != old).count() == 0
    assert df.filter(X.strip(F.col("t")) != F.col("t")).count() == len(X.WHITE)


@pytest.mark.parametrize("rules", [V.ROLES, V.SENIORITY, [(r"\bcolou?r\b", "c"), (r"\bx(y)*\b", "x"), (r"\b|z", "any")]])
def test_first_match_equals_each_pattern_in_turn(spark, rules):
    rng = random.Random(3)
    pool = ["data", "engineer", "analyst", "bi", "ml", "&", "reporting", "manager", "quality", "dba", "ops", "solution", "lead", "senior",
            "database", "administrator", "color", "x", "xyy", "kế toán", "datamanager", "intern", "_"]
    texts = [rng.choice(["", " ", "  ", "-"]).join(rng.choices(pool, k=rng.randint(0, 4))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.when(F.col("t").rlike(X.word_borders(p)), F.lit(v)) for p, v in rules])
    assert df.filter(~X.first_match(F.col("t"), rules).eqNullSafe(plain)).count() == 0


def test_city_is_the_first_of_the_list(spark):
    rng = random.Random(4)
    names = [n for ns in V.CITIES.values() for n in ns]
    texts = [" ".join(rng.choices([*names, "Tokyo", "(x)", "-"], k=rng.randint(1, 3))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.c for r in df.select(N.city_of(F.col("t")).alias("c")).collect()]
    assert got == [next((c for c, ns in V.CITIES.items() if any(n in t.lower() for n in ns)), t) for t in texts]


def test_deeper_layers_with_white_space_of_any_kind(spark):
    words = ["data lake", "data lake house", "sql", "sql server", *"abcdefghijk", "-x", "a b"]
    texts = ["data  lake\thouse", "data lake", "sql\n server", "a  b", "k j -x", "-x", "data lakehouse", "sqlserver"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(X.keywords_in(F.col("t"), words).alias("f"))
    want = [["data lake", "data lake house"], ["data lake"], ["sql", "sql server"], ["a", "a b", "b"], ["-x", "j", "k"], ["-x"], [], []]
    assert [r.f for r in df.collect()] == want


def test_place_is_computed_once(spark):
    plan = spark.createDataFrame([("a",)], "t string").select(N.clean_location(F.col("t")).alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split_part") <= 1 and len(re.findall(r"\\\(\[\^\)\]", plan)) <= 1


def test_new_silver_is_made_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def mark(batches):
        runs.add(1)
        yield from batches

    df = spark.range(5, numPartitions=1).mapInArrow(mark, "id long")
    assert io.write_silver(df, str(tmp_path / "a")) and runs.value == 1
    assert spark.read.parquet(str(tmp_path / "a")).count() == 5
    for kind in ("parquet", "csv"):
        none = spark.range(5).filter("id < 0")
        assert not io.write_silver(none, str(tmp_path / "b"), kind) and not (tmp_path / "b").exists()
        assert not io.write_silver(none, str(tmp_path / "a"), kind) and spark.read.parquet(str(tmp_path / "a")).count() == 5
