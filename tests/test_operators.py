"""Ingest, Gold, quality and the whole run on small tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from vacancy_lake import schemas
from vacancy_lake.functions import pages
from vacancy_lake.operators import gold, ingest, ngrams, quality, silver
from vacancy_lake.plans import medallion
from vacancy_lake.sources import io
from vacancy_lake.streaming import ingest as stream

LIST = "ord long, title string, company string, location string, salary string, experience string, url string"
DETAIL = "ord long, id string, normalized_url string, title string, company string, salary string"
TEXT = "ord long, normalized_url string, description string, crawled_at string"


def sources(spark):
    listed = spark.createDataFrame(
        [(1, "A", " ", "Hà Nội", "", "3 năm", "u/1.html?x=1"), (2, "", "C", None, "10 triệu", None, "u/2.html"), (3, "Z", "", "", "", "", None)],
        LIST,
    )
    detail = spark.createDataFrame(
        [(1, "9", "u/1.html", "B", "Co", "5 triệu"), (2, None, "/7.html", None, None, None), (3, "4", "", "x", "y", "z")], DETAIL
    )
    text = spark.createDataFrame([(1, "u/2.html", "Python", "t"), (2, "/7.html", " ", None)], TEXT)
    return listed, detail, text


def test_merge_takes_the_first_non_blank_value(spark):
    rows = {r.normalized_url: r for r in ingest.fill_defaults(ingest.merge_sources(*sources(spark))).collect()}
    assert set(rows) == {"u/1.html", "u/2.html", "/7.html"}
    assert (rows["u/1.html"].title, rows["u/1.html"].company, rows["u/1.html"].salary, rows["u/1.html"].id) == ("A", "Co", "5 triệu", "9")
    assert rows["u/2.html"].description == "Python" and rows["u/2.html"].title == "Job 2"
    assert rows["/7.html"].title == "Job 7" and rows["/7.html"].source == "TopCV"
    assert ingest.merge_keys(*sources(spark)).count() == 3


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert {tuple(r) for r in ingest.overlay(old, new, "k").collect()} == {(1, "a", "x"), (2, None, "y"), (3, "c", None)}
    assert {tuple(r) for r in ingest.insert_only(old, new, "k").collect()} == {(1, "a", "x"), (2, "b", "y"), (3, "c", None)}
    assert tuple(ingest.insert_counts(old, new, "k").first()) == (3, 1)
    assert [r.k for r in ingest.pending(old, new, "k").collect()] == [1]


def test_insert_only_passes_over_null_keys_and_repeats(spark):
    old = spark.createDataFrame([("a", 0), (None, 1)], "k string, o int")
    new = spark.createDataFrame([("b", 3), ("b", 2), (None, 4), ("", 5), ("a", 6), (None, 7)], "k string, o int")
    assert sorted(ingest.insert_only(old, new, "k", ["o"]).collect(), key=lambda r: r.o) == [("a", 0), (None, 1), ("b", 2)]
    assert tuple(ingest.insert_counts(old, new, "k").first()) == (3, 1)
    assert ingest.insert_only(old.filter("false"), new.filter("false"), "k").count() == 0
    runs = spark.createDataFrame([("x", None), ("x", "late"), ("y", None)], "r string, e string")
    summary = ingest.run_summary(runs, "r", F.lit(True), F.lit(False), F.col("e"))
    assert {(r.r, r.status, r.error) for r in summary.collect()} == {("x", "failed", "late"), ("y", "success", None)}
    assert tuple(ingest.run_exit_code(summary).first()) == (1, 1, 1)


def test_keep_first_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 0)], "k string, o int")
    assert [tuple(r) for r in ingest.keep_first(df, F.col("k"), ["o"]).collect()] == [("a", 1)]


def test_gold_on_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("b", "X", 1.0, ["p", "q"]), ("a", "X", None, ["p"]), (None, None, 3.0, []), ("a", None, 5.0, None)],
        "normalized_role string, location_clean string, salary_max double, skills array<string>",
    )
    m = gold.metrics(df).first()
    assert (m.total_jobs, m.avg_salary_max, m.top_role, m.top_location) == (4, 3.0, "a", "X")
    assert [tuple(r) for r in gold.top_skills(df).collect()] == [("p", 2), ("q", 1)]
    none = gold.metrics(df.filter("false")).first()
    assert (none.total_jobs, none.avg_salary_max, none.top_role) == (0, None, None)


SILVERISH = "job_url string, title string, company string, location_clean string, normalized_role string, salary_min double, salary_max double, currency string, is_negotiable boolean, exp_min int, exp_max int, work_mode string, seniority_level string, deadline string, skills array<string>, crawled_at string"


def rows(spark, n, **changes):
    base = dict(job_url="u", title="Data Engineer", company="c", location_clean="Hà Nội", normalized_role="Data Engineer", salary_min=1.0, salary_max=2.0, currency="VND", is_negotiable=False, exp_min=1, exp_max=2, work_mode="Onsite", seniority_level="Junior", deadline="2026-01-01", skills=["sql"], crawled_at="2026-01-01")
    return spark.createDataFrame([tuple((base | changes | {"job_url": f"u{k}"}).values()) for k in range(n)], SILVERISH)


@pytest.mark.parametrize(("bad", "status"), [(0, "OK"), (1, "OK"), (2, "WARNING"), (5, "ERROR")])
def test_completeness_thresholds(spark, bad, status):
    df = rows(spark, 20 - bad).unionByName(rows(spark, bad, title=" ")) if bad else rows(spark, 20)
    got = {r.check: r for r in quality.completeness(df).collect()}
    assert got["title"].status == status and got["title"]["count"] == 20 - bad


@pytest.mark.parametrize(("n", "status"), [(5, "OK"), (6, "WARNING"), (15, "WARNING"), (16, "ERROR")])
def test_validity_counts(spark, n, status):
    df = rows(spark, n, salary_min=9.0, deadline="31/12/2026", seniority_level="Intern").unionByName(rows(spark, 3))
    got = {r.check: r for r in quality.validity(df).collect()}
    assert {got[c].status for c in ("salary_min_le_max", "valid_deadline", "valid_seniority")} == {status}
    assert got["valid_currency"]["count"] == 0


def test_accuracy_uniqueness_timeliness(spark):
    df = rows(spark, 3, is_negotiable=True, exp_max=20).unionByName(rows(spark, 1, salary_min=None, salary_max=None))
    got = {r.check: r for r in quality.accuracy(df).collect()}
    assert got["accurate_negotiable_salary"]["count"] == 3 and got["accurate_missing_salary"]["count"] == 1
    assert got["outlier_experience"].status == "WARNING" and got["outlier_salary_usd"].status == "OK"
    u = {r.check: r for r in quality.uniqueness(rows(spark, 3).unionByName(rows(spark, 3, title="Kế toán"))).collect()}
    assert u["duplicate_job_url"]["count"] == 3 and u["duplicate_job_url"].status == "WARNING"
    assert u["role_title_consistency"]["count"] == 3 and u["role_title_consistency"].status == "OK"
    as_of = F.lit(dt.datetime(2026, 3, 1))
    assert quality.timeliness(df, as_of).first().status == "WARNING"
    assert quality.timeliness(df.drop("crawled_at"), as_of).first()["count"] == 0


def test_empty_tables_and_missing_columns(spark):
    none = rows(spark, 1).filter("false")
    stages = quality.stages(F.current_timestamp())
    assert quality.run_stages(none, stages).count() == 0
    assert quality.gate(quality.run_stages(none, stages)).first().exit_code == 0
    bare = rows(spark, 2).select("job_url")
    got = {r.check: r.status for r in quality.run_stages(bare, stages).collect()}
    assert got["title"] == "ERROR" and got["valid_currency"] == "OK" and got["stale_records"] == "OK"
    with pytest.raises(ValueError):
        quality.run_stages(bare, stages, ["nothing"])


def test_violation_sample(spark):
    v = quality.violations(rows(spark, 13, exp_max=20), quality.accuracy_rules(), ["exp_max"])
    sample = quality.violation_sample(v, 10).collect()
    assert len(sample) == 10 and sample[0].more == 3 and json.loads(sample[0].detail) == {"exp_max": 20}


def test_stages_fail_alone_and_share_a_pass(spark):
    late = quality.Checks("late", lambda df: {"x": F.count_if(F.raise_error(F.lit("late")).isNull())}, F.lit("OK"))
    got = quality.run_stages(rows(spark, 2), {"late": late, "validity": quality.validity_checks()}).collect()
    assert {r.stage for r in got} == {"late", "validity"}
    assert [r.status for r in got if r.stage == "late"] == ["ERROR"] and len(got) == 7


def test_silver_computes_each_value_once(spark):
    merged = ingest.fill_defaults(ingest.merge_sources(*sources_full(spark)))
    merged = spark.createDataFrame(merged.collect(), merged.schema)
    plan = silver.to_silver(merged)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") < 6 and plan.count("regexp_replace") < 15
    for table in (gold.salary_by_role, gold.skills_by_role):
        plan = table(silver.to_silver(merged))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("dba") == 1  # the role's patterns stand once


def test_report_is_written_once_per_run(spark, tmp_path):
    df = rows(spark, 3, salary_min=9.0)
    results = quality.run_stages(df, quality.stages(F.current_timestamp()))
    for _ in range(2):
        io.write_report(results, quality.violations(df, quality.validity_rules(), ["salary_min"]), str(tmp_path), "2026-01-02T03:04:05", "t", 3, 1)
    day = tmp_path / "2026-01-02"
    assert spark.read.json(str(day / "report_2026-01-02_03-04-05.json")).count() == results.count()
    text = spark.read.text(str(day / "report_2026-01-02_03-04-05.md"))
    assert text.filter("value LIKE '- total_records: 3'").count() == 1
    assert spark.read.json(str(day / "violations_2026-01-02_03-04-05.json")).count() == 3


def test_salary_places():
    page = '<div>x <b>Mức lương</b>: 10 - 20 triệu</div><p data-salary="1">30 USD</p><i class="salary-box">Competitive</i>'
    found = pages.salary_places(page)
    assert found["labels"][0] == "x : 10 - 20 triệu" and found["marked"] == ["Competitive", "30 USD"]
    assert pages.salary_places("<p>no</p>") == {"labels": [], "marked": []}


def test_labels_of_one_page(spark):
    page = "<div class='item'><b>Level</b><i>S</i></div><p><u>Kind</u><i>K</i></p>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "k int, html string")
    got = {r.k: (r.a, r.b) for r in pages.values_by_label(df, {"a": "Level", "b": "Kind"}, "k").collect()}
    assert got == {1: ("S", "K"), 2: ("", ""), 3: ("", "")}


def test_ngrams(spark):
    df = spark.createDataFrame([("Big data, big team",), ("big Data experience",), ("",), (None,)], "t string")
    got = {r.gram: r["count"] for r in ngrams.ngram_counts(df, F.col("t"), min_count=1).collect()}
    assert got["big"] == 3 and got["big data"] == 2 and got["big data big"] == 1 and "team" not in got


def test_records_that_are_missing_or_malformed(spark, tmp_path):
    assert io.read_records(spark, str(tmp_path / "none"), schemas.LISTING).count() == 0
    (tmp_path / "a.json").write_text('[{"title": "x", "more": 1}, {"title": null}]')
    (tmp_path / "b.json").write_text("{ no json")
    assert sorted(r.title or "" for r in io.read_records(spark, str(tmp_path), schemas.LISTING).collect()) == ["", "x"]
    with pytest.raises(ValueError):
        io.read_table(spark, "x.txt")
    with pytest.raises(ValueError):
        io.write_silver(spark.range(1), "x", "orc")


def test_whole_run(spark, tmp_path):
    done = medallion.run(*sources_full(spark), str(tmp_path), as_of=F.lit(dt.datetime(2026, 1, 5)), stop_on_error=False)
    assert done.silver.count() == 2 and done.silver.schema.names == schemas.SILVER.names
    assert spark.read.parquet(f"{tmp_path}/rejects.parquet").count() == 1
    assert set(done.gold) == set(gold.TABLES)
    assert spark.read.parquet(f"{tmp_path}/gold/metrics.parquet").first().total_jobs == 2


def sources_full(spark):
    detail = "ord long, id string, normalized_url string, title string, deadline string, level string, number_of_hires int, job_type string, working_time string, crawled_at string"
    listed = spark.createDataFrame(
        [(1, "Data Engineer", "C", "Hà Nội", "10 triệu", "3 năm", "u/1.html"), (2, "BI Analyst", "D", "Huế", "Lương, thưởng", "", "u/2.html"), (3, "DBA", "E", "", "", "", "u/3.html")],
        LIST,
    )
    more = spark.createDataFrame([(1, "1", "u/1.html", "x", "2026-02-01", "S", 2, "Thực tập", "WFH", "2026-01-01")], detail)
    text = "ord long, normalized_url string, description string, requirements string, benefits string"
    return listed, more, spark.createDataFrame([(1, "u/1.html", "Python", "SQL", "b")], text)


def test_silver_accounts_for_every_row(spark):
    merged = ingest.fill_defaults(ingest.merge_sources(*sources_full(spark)))
    good = silver.to_silver(merged)
    assert good.count() + silver.rejects(merged).count() == merged.count()
    first = good.filter("job_id = '1'").first()
    assert first.skills == ["python", "sql"] and first.work_mode == "Remote" and first.job_schedule_type == "Internship"
    assert good.filter(F.size(F.array_intersect("skills", "domain_keywords")) > 0).count() == 0


def test_stream_resumes_and_inserts_only(spark, tmp_path):
    landing, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    one = spark.createDataFrame([("u/1?a", 1), ("u/1", 2), (None, 3)], "url string, o int")
    one.coalesce(1).write.mode("append").parquet(landing)
    for expected in (["u/1"], ["u/1", "u/2"]):
        records = stream.read_stream(spark, landing, one.schema, "parquet")
        stream.ingest(records, target, marks, order=["o"]).awaitTermination()
        got = spark.read.parquet(target)
        assert sorted(r.normalized_url for r in got.collect()) == expected
        assert got.filter("normalized_url = 'u/1'").first().o == 1
        spark.createDataFrame([("u/1", 0), ("u/2", 9)], one.schema).coalesce(1).write.mode("append").parquet(landing)
