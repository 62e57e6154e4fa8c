"""Gold tables from partial aggregates of batches equal those of the whole Silver table."""

import random

import pytest
from pyspark.sql import functions as F

from vacancy_lake import schemas
from vacancy_lake.operators import gold, gold_parts


def postings(spark, n, seed=3):
    rng, rows = random.Random(seed), []
    pick = lambda *v: rng.choice([None, *v])
    for k in range(n):
        r = dict.fromkeys(schemas.SILVER.names)
        r |= {
            "job_id": str(k),
            "normalized_role": pick("Data Engineer", "Data Analyst", "BI Analyst"),
            "seniority_level": pick("Junior", "Senior"),
            "location_clean": pick("Hà Nội", "Đà Nẵng", "Huế"),
            "work_mode": pick("Remote", "Onsite"),
            "salary_min": pick(*[rng.randint(5, 40) / 2 for _ in range(3)]),
            "salary_max": pick(*[rng.randint(40, 90) / 2 for _ in range(3)]),
            "skills": pick([], rng.sample(["sql", "python", "r", "c++", "spark", "dbt", "aws"], 3)),
            "domain_keywords": pick([], ["ai"], ["ai", "llm"]),
        }
        rows.append(tuple(r[c] for c in schemas.SILVER.names))
    return spark.createDataFrame(rows, schemas.SILVER)


def content(tables):
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return {n: sorted(str([plain(v) for v in r]) for r in t.collect()) for n, t in tables.items()}


def test_any_split_equals_the_whole_build(spark, tmp_path):
    silver = postings(spark, 400)
    silver = spark.createDataFrame(silver.collect(), schemas.SILVER)
    want = content(gold.build_gold(silver))
    assert all(want.values())
    for k, parts in enumerate((1, 3, 7)):
        store = str(tmp_path / f"s{k}")
        for b in range(parts):
            gold_parts.put_batch(silver.filter(F.pmod(F.hash("job_id"), F.lit(parts)) == b), store, f"b{b}")
        got = gold_parts.read_tables(spark, store)
        assert content(got) == want
        assert {n: t.columns for n, t in got.items()} == {n: t.columns for n, t in gold.build_gold(silver).items()}


def test_a_batch_given_again_replaces_itself_and_a_dying_one_is_not_seen(spark, tmp_path, monkeypatch):
    store, first, second = str(tmp_path / "s"), postings(spark, 50, 1), postings(spark, 60, 2)
    gold_parts.put_batch(first, store, "a")
    gold_parts.put_batch(second, store, "b")
    gold_parts.put_batch(first, store, "a")
    want = content(gold.build_gold(first.unionByName(second)))
    assert content(gold_parts.read_tables(spark, store)) == want

    def dies(*_):
        raise RuntimeError

    with monkeypatch.context() as m:
        m.setattr(gold_parts, "_commit", dies)
        with pytest.raises(RuntimeError):
            gold_parts.put_batch(second, store, "c")
    assert content(gold_parts.read_tables(spark, store)) == want
    gold_parts.put_batch(postings(spark, 70, 4), store, "b")
    assert content(gold_parts.read_tables(spark, store)) == content(gold.build_gold(first.unionByName(postings(spark, 70, 4))))


def test_empty_batches_and_stores(spark, tmp_path):
    store, empty = str(tmp_path / "s"), spark.createDataFrame([], schemas.SILVER)
    want = content(gold.build_gold(empty))
    assert content(gold_parts.read_tables(spark, store)) == want
    gold_parts.put_batch(empty, store, "a")
    assert content(gold_parts.read_tables(spark, store)) == want


def test_a_batch_is_scanned_once(spark):
    plan = gold_parts.partials(spark.read.schema(schemas.SILVER).parquet("/root/testdata/sf0.001/pages.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
