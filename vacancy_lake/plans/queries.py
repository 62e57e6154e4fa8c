"""Every operator as a query (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import normalise as N
from ..functions import pages as H
from ..functions.text import collapse_spaces, keywords_in, phrases_in
from ..operators import gold, gold_parts, ingest, keyed_files, ngrams, quality, silver
from ..sources import io, landing
from ..sources.postings import merge_sources, postings
from ..sources.scratch import scratch_path
from ..streaming import ingest as stream
from .oracles import JOB_PAGE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.to_silver(postings(spark, sf_dir))


def on_postings(name: str, make: Callable[[], list]) -> None:
    """A query that projects the postings: ord and the columns of ``make``."""
    QUERIES[name] = lambda spark, sf_dir: postings(spark, sf_dir).select("ord", *make())


def on_silver(name: str, f: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: f(silver_of(spark, sf_dir))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def joined(c: str):
    return F.array_join(c, ",").alias(c)




def texts() -> list:
    return [F.col(c) for c in ("title", "description", "requirements")]


# --- projections --------------------------------------------------------------------------------

on_postings("P1_clean_location", lambda: [N.clean_location(F.col("location")).alias("location_clean")])
on_postings("P2_parse_experience", lambda: [F.inline(F.array(N.parse_experience(F.col("experience"))))])
on_postings("P3_parse_salary", lambda: [F.inline(F.array(N.parse_salary(F.col("salary"))))])
on_postings("P4_extract_skills", lambda: [F.array_join(N.extract_skills(*texts()), ",").alias("skills")])
on_postings("P5_extract_domains", lambda: [F.array_join(N.extract_domains(*texts()), ",").alias("domains")])
on_postings("P6_normalize_role", lambda: [N.normalize_role(F.col("title")).alias("normalized_role")])
on_postings(
    "P7_derive_seniority",
    lambda: [N.derive_seniority(F.col("title"), N.parse_experience(F.col("experience"))["exp_min"]).alias("seniority_level")],
)
on_postings(
    "P8_work_mode",
    lambda: [F.inline(F.array(N.derive_work_mode(*[F.col(c) for c in ("working_time", "description", "requirements")])))],
)
on_postings("P9_schedule_type", lambda: [N.schedule_type(F.col("job_type")).alias("job_schedule_type")])


@query("P4_skills_documents")
def _(spark, sf_dir):
    words = ["ai", "r", "license", "the", "public license", "in", "cc by", "c++"]
    found = keywords_in(F.lower("text"), words)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, ",").alias("found"))


@query("P5_domains_documents")
def _(spark, sf_dir):
    found = phrases_in(F.lower("text"), ["ai", "r", "license", "the", "public license", "in"])
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, ",").alias("found"))


on_silver(
    "P10_silver", lambda s: s.withColumns({c: F.array_join(c, ",") for c in ("skills", "domain_keywords")})
)


@query("P11_rejects")
def _(spark, sf_dir):
    return silver.rejects(postings(spark, sf_dir))


@query("P12_typed_record")
def _(spark, sf_dir):
    raw = postings(spark, sf_dir).select(
        F.col("id").alias("job_id"),
        F.concat("crawled_at", F.lit("T00:00:00Z")).alias("crawled_at"),
        F.replace(F.col("title"), F.lit(" "), F.lit(" ,, ")).alias("skills"),
        F.lit(1).alias("unknown"),
    )
    return silver.typed_record(raw).withColumns(
        {"skills": F.array_join("skills", "|"), "crawled_at": F.col("crawled_at").cast("timestamp_ntz")}
    )


@query("P13_iso_text")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", N.timestamp_to_iso(F.col("ts")).alias("iso"))


@query("P14_parse_list")
def _(spark, sf_dir):
    p = postings(spark, sf_dir)
    text = F.concat(F.lit("['"), F.array_join(N.extract_skills(*texts()), "', '"), F.lit("']"))
    found = F.array_remove(N.parse_list(text), "")
    return p.select("ord", F.array_join(found, ",").alias("items"), F.size(found).alias("n"))


@query("P15_deadline")
def _(spark, sf_dir):
    form = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "dd-MM-yyyy")
    )
    page = F.concat(F.lit("Hạn nộp hồ sơ: "), F.date_format("o_orderdate", "dd/MM/yyyy"))
    field = F.when(F.col("o_orderkey") % 3 == 0, "xem trang").otherwise(form)
    return table(spark, sf_dir, "orders").select("o_orderkey", N.deadline_or_page(field, page).alias("deadline"))


on_postings("P16_first_integer", lambda: [N.first_integer(F.col("url")).alias("n")])
on_postings(
    "P17_fill_city",
    lambda: [N.fill_city(F.when(F.col("ord") % 3 == 0, "").otherwise(F.col("location")), F.col("location")).alias("city")],
)
on_postings(
    "P19_salary_noise",
    lambda: [
        N.blank_salary_noise(
            F.when(F.col("ord") % 4 == 0, "Xem mức lương thị trường cho vị trí này").otherwise(F.col("salary"))
        ).alias("salary")
    ],
)


@query("P18_collapse_spaces")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", collapse_spaces(F.col("text")).alias("text"))


@query("P20_salary_with_unit")
def _(spark, sf_dir):
    n, m = (F.col("ord") % 900 + 100).cast("string"), (F.col("ord") % 900 + 1100).cast("string")
    text = F.concat(
        F.when(F.col("ord") % 3 == 0, F.concat(F.lit("Up to "), n))
        .when(F.col("ord") % 3 == 1, F.concat(n, F.lit(" - "), F.format_number((F.col("ord") % 900 + 1100), 0)))
        .otherwise(n),
        F.lit(" USD / "),
        F.when(F.col("ord") % 2 == 0, "year").otherwise("month"),
    )
    parsed = N.parse_salary_with_unit(text)
    return postings(spark, sf_dir).select("ord", *[parsed[c].alias(c) for c in ("salary_min", "salary_max", "currency", "unit", "is_negotiable")])


@query("P21_salary_text_valid")
def _(spark, sf_dir):
    n = (F.col("ord") % 100 + 10).cast("string")
    text = (
        F.when(F.col("ord") % 5 == 0, F.concat(n, F.lit(" - 900 USD")))
        .when(F.col("ord") % 5 == 1, F.concat(F.lit("IT Salary Report "), n))
        .when(F.col("ord") % 5 == 2, F.lit("2024-06"))
        .when(F.col("ord") % 5 == 3, F.concat(n, F.lit(" - 950")))
        .otherwise(F.lit("2024 - 2026"))
    )
    p = N.parse_salary_with_unit(text)
    return postings(spark, sf_dir).select("ord", N.is_salary_text(text, p["salary_min"], p["salary_max"]).alias("valid"))


@query("P22_source_job_id")
def _(spark, sf_dir):
    slug = F.col("page_id").cast("string")
    url = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise("")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        N.source_job_id("itviec", slug).alias("job_id"),
        N.job_url_or_slug(url, slug, "https://jobs.example.test/it-jobs/").alias("job_url"),
    )


on_postings(
    "P23_salary_hidden",
    lambda: [N.salary_hidden(F.when(F.col("ord") % 6 == 0, "Sign in to view salary").otherwise(F.col("salary"))).alias("hidden")],
)

# --- ingest -------------------------------------------------------------------------------------


def keyed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", ingest.normalize_url(F.col("url")).alias("key"))


def old_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two sides of the pages that overlap; every page is on at least one."""
    pages = keyed_pages(spark, sf_dir)
    return pages.filter("page_id % 3 <> 0"), pages.filter("page_id % 2 = 0 OR page_id % 3 = 0")


def arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two sides, with what an upsert must leave out: new rows that repeat a key or have none."""
    old, new = old_and_new(spark, sf_dir)
    again = new.selectExpr("page_id + 1000000000 AS page_id", "CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '' ELSE key END AS key")
    return old, new.unionByName(again)


@query("M1_normalize_url")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", ingest.normalize_url(F.col("url")).alias("normalized_url"))


@query("M2_merge_keys")
def _(spark, sf_dir):
    return ingest.merge_keys(*merge_sources(spark, sf_dir))


@query("M3_merge_sources")
def _(spark, sf_dir):
    return ingest.merge_sources(*merge_sources(spark, sf_dir))


@query("M4_id_from_url")
def _(spark, sf_dir):
    given = F.when(F.col("ord") % 2 == 0, F.col("id")).otherwise("")
    return postings(spark, sf_dir).select("ord", ingest.id_or_from_url(given, F.col("url")).alias("id"))


@query("M5_defaults")
def _(spark, sf_dir):
    merged = ingest.merge_sources(*merge_sources(spark, sf_dir))
    return ingest.fill_defaults(merged).select("normalized_url", "id", "title", "source")


@query("M6_keep_first")
def _(spark, sf_dir):
    pages = keyed_pages(spark, sf_dir).filter("key IS NOT NULL")
    host = F.regexp_extract("key", "^[a-z]+://([^/]+)", 1)
    return ingest.keep_first(pages, host, ["page_id"])


@query("M7_insert_only")
def _(spark, sf_dir):
    old, new = arrivals(spark, sf_dir)
    return ingest.insert_only(old.withColumn("side", F.lit("old")), new.withColumn("side", F.lit("new")), "key", ["page_id"])


@query("M7_insert_counts")
def _(spark, sf_dir):
    return ingest.insert_counts(*arrivals(spark, sf_dir), "key")


@query("M7_insert_only_all")
def _(spark, sf_dir):
    old, new = old_and_new(spark, sf_dir)
    return ingest.insert_only(old.withColumn("side", F.lit("old")), new.withColumn("side", F.lit("new")), "key", ["page_id"])


@query("M7_insert_counts_all")
def _(spark, sf_dir):
    return ingest.insert_counts(*old_and_new(spark, sf_dir), "key")


@query("M8_overlay")
def _(spark, sf_dir):
    p = postings(spark, sf_dir)
    old = p.filter("ord % 3 <> 0").select("ord", "company", "title")
    new = p.filter("ord % 2 = 0").select("ord", F.lit(None).cast("string").alias("company"), "deadline")
    return ingest.overlay(old, new, "ord")


@query("M8_overlay_files")
def _(spark, sf_dir):
    """The same overlay on a table of slices: a small update of the last keys, then a large one."""
    p = postings(spark, sf_dir)
    target = scratch_path(spark, "keyed")
    keyed_files.create_keyed(p.filter("ord % 3 <> 0").select("ord", "company", "title"), target, "ord", rows_per_slice=2000)
    last = p.agg(F.max("ord").alias("last")).first().last
    new = p.filter("ord % 2 = 0").select("ord", F.lit(None).cast("string").alias("company"), "deadline")
    for part in (F.col("ord") > last - 1000, F.col("ord") <= last - 1000):
        keyed_files.overlay_keyed(new.filter(part), target, "ord", rows_per_slice=2000)
    return keyed_files.read_keyed(spark, target).select("ord", "company", "title", "deadline")


@query("M9_pending")
def _(spark, sf_dir):
    return ingest.pending(*old_and_new(spark, sf_dir), "key")


@query("M10_resume")
def _(spark, sf_dir):
    checkpoint = keyed_pages(spark, sf_dir).filter("page_id % 5 = 0")
    return ingest.resume(*old_and_new(spark, sf_dir), checkpoint, "key")


@query("M9_pending_by_bitmap")
def _(spark, sf_dir):
    """Orders without a returned item."""
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return ingest.pending_by_bitmap(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), returned, "o_orderkey")


@query("M9_pending_all")
def _(spark, sf_dir):
    return ingest.pending(*old_and_new(spark, sf_dir), "key")


@query("M10_resume_all")
def _(spark, sf_dir):
    checkpoint = keyed_pages(spark, sf_dir).filter("page_id % 5 = 0")
    return ingest.resume(*old_and_new(spark, sf_dir), checkpoint, "key")


@query("M10_stream_ingest")
def _(spark, sf_dir):
    """Pages as a file stream, upserted insert-only; neither the second run nor one that has lost its
    checkpoint finds anything new."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    landing, target, marks, others = (scratch_path(spark, n) for n in ("landing", "target", "marks", "marks"))
    pages.write.parquet(landing)
    for checkpoint in (marks, marks, others):
        records = stream.read_stream(spark, landing, pages.schema, "parquet")
        stream.ingest(records, target, checkpoint, order=["page_id"]).awaitTermination()
    return stream.read_target(spark, target).select("page_id", "normalized_url")


@query("M10_lost_checkpoint")
def _(spark, sf_dir):
    """Two thirds of the pages land; the rest and some of the first land elsewhere after the checkpoint is lost."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    target = scratch_path(spark, "target")
    for part in ("page_id % 3 <> 0", "page_id % 2 = 0 OR page_id % 3 = 0"):
        landing, marks = scratch_path(spark, "landing"), scratch_path(spark, "marks")
        pages.filter(part).write.parquet(landing)
        records = stream.read_stream(spark, landing, pages.schema, "parquet")
        stream.ingest(records, target, marks, order=["page_id"]).awaitTermination()
    return stream.read_target(spark, target).select("page_id", "normalized_url")


@query("M11_repair_titles")
def _(spark, sf_dir):
    p = postings(spark, sf_dir).withColumn("normalized_url", ingest.normalize_url(F.col("url")))
    bad = (
        F.when(F.col("ord") % 4 == 0, "Tin tuyển dụng")
        .when(F.col("ord") % 4 == 1, F.col("company"))
        .when(F.col("ord") % 4 == 2, "at topcv.vn")
        .otherwise(F.col("title"))
    )
    repaired = ingest.repair_titles(p.withColumn("title", bad), p)
    return repaired.select("ord", "title", "original_title")


@query("M12_overlay_matched")
def _(spark, sf_dir):
    p = postings(spark, sf_dir)
    salary = N.parse_salary(F.col("salary"))
    detail = p.filter("ord % 2 = 0").select("ord", salary["salary_min"].alias("salary_min"), salary["salary_max"].alias("salary_max"))
    return ingest.overlay_matched(p.filter("ord % 3 <> 0").select("ord", "company"), detail, "ord")


@query("M13_run_summary")
def _(spark, sf_dir):
    p = postings(spark, sf_dir).select(
        "ord", N.normalize_role(F.col("title")).alias("normalized_role"), N.parse_salary(F.col("salary"))["salary_max"].alias("s")
    )
    return rounded(
        ingest.run_summary(p, "normalized_role", F.col("ord") % 2 == 0, F.col("s").isNotNull(), failure()), "found_share"
    )


def failure():
    return F.when((F.col("ord") % 997 == 5) & F.col("normalized_role").startswith("Data"), "page not delivered")


@query("M13_run_exit_code")
def _(spark, sf_dir):
    p = postings(spark, sf_dir).select("ord", N.normalize_role(F.col("title")).alias("normalized_role"))
    return ingest.run_exit_code(ingest.run_summary(p, "normalized_role", F.lit(True), F.lit(True), failure()))


@query("M14_keyword_titles")
def _(spark, sf_dir):
    return ingest.keyword_titles(postings(spark, sf_dir)).select("ord", "title")


@query("M15_valid_page")
def _(spark, sf_dir):
    status = F.when(F.col("page_id") % 7 == 0, 503).otherwise(200)
    final = F.when(F.col("page_id") % 5 == 0, F.lit("https://other.example.test/")).otherwise(F.col("url"))
    valid = ingest.valid_page(F.col("html"), status, final, F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", valid.alias("valid"))


@query("M16_union_listings")
def _(spark, sf_dir):
    p = postings(spark, sf_dir)
    first = p.filter("ord % 2 = 0").select("id", "title", "company", "url", "location")
    second = p.filter("ord % 2 = 1").select(
        F.col("id").alias("job_id"), F.col("title").alias("job_title"), F.col("company").alias("company_name"),
        F.col("url").alias("job_url"), F.lit("Hybrid").alias("work_model"),
    )
    return ingest.union_listings(first, second)


# --- pages --------------------------------------------------------------------------------------


def job_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).selectExpr("ord", f"{JOB_PAGE} AS html")


def on_job_pages(name: str, make: Callable[[], list]) -> None:
    QUERIES[name] = lambda spark, sf_dir: job_pages(spark, sf_dir).select("ord", *make())


@query("H1_title_heading")
def _(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", H.page_title(html).alias("title"), H.first_heading_source(html).alias("h1"))


on_job_pages("H2_sections", lambda: [F.inline(F.array(H.job_sections(F.col("html"))))])


@query("H3_value_by_label")
def _(spark, sf_dir):
    return H.values_by_label(job_pages(spark, sf_dir), {"job_level": "Cấp bậc"}, "ord")


@query("H4_listing_cards")
def _(spark, sf_dir):
    return H.listing_cards(job_pages(spark, sf_dir), "job-card", "https://jobs.example.test", "ord")


@query("H5_json_ld_salary")
def _(spark, sf_dir):
    found = job_pages(spark, sf_dir).select("ord", F.inline(F.array_compact(F.array(H.salary_from_json_ld(F.col("html"))))))
    return found


@query("H6_html_salary")
def _(spark, sf_dir):
    return job_pages(spark, sf_dir).select("ord", F.inline(F.array(H.salary_from_html(F.col("html")))))


@query("H6_html_salary_all")
def _(spark, sf_dir):
    found = job_pages(spark, sf_dir).select("ord", F.inline(F.array(H.salary_from_html(F.col("html")))))
    return found.select("ord", "salary_min", "salary_max", "salary_source")


@query("H7_salary_cascade")
def _(spark, sf_dir):
    source = H.salary_of_page(F.col("html"))["salary_source"].alias("salary_source")
    return job_pages(spark, sf_dir).select(source).groupBy("salary_source").agg(F.count("*").alias("n"))


on_job_pages("H8_experience_snippet", lambda: [H.experience_snippet(F.col("html")).alias("snippet")])


@query("H9_brand_description")
def _(spark, sf_dir):
    return job_pages(spark, sf_dir).select("ord", H.brand_description(F.col("html")).alias("description"))


on_job_pages("H9_brand_description_all", lambda: [H.brand_description(F.col("html")).alias("description")])


on_job_pages("H10_visible_text", lambda: [H.visible_text(F.col("html")).alias("text")])


# --- aggregates ---------------------------------------------------------------------------------

on_silver("G1_metrics", lambda s: rounded(gold.metrics(s), "avg_salary_max"))
on_silver("G2_salary_by_role", lambda s: rounded(gold.salary_by_role(s), "salary_min_mean", "salary_max_mean"))
on_silver("G3_salary_by_seniority", lambda s: rounded(gold.salary_by_seniority(s), "salary_max_mean"))
on_silver("G4_heatmap_salary", lambda s: rounded(gold.heatmap_salary(s), "salary_max_mean"))
on_silver("G5_top_skills", gold.top_skills)
on_silver("G6_skills_by_role", gold.skills_by_role)
on_silver("G7_location_distribution", gold.location_distribution)
on_silver("G8_work_mode_distribution", gold.work_mode_distribution)
on_silver("G9_top_domains", gold.top_domains)
on_silver("D1_filter_options", lambda s: gold.filter_options(s, "normalized_role"))
CHOICES = {
    "normalized_role": ["Data Engineer", "Data Analyst"],
    "location_clean": ["Hà Nội", "Đà Nẵng"],
    "seniority_level": ["Junior", "Senior"],
}
on_silver("D2_selected_share", lambda s: gold.selected_share(s, CHOICES))
LEVELS = ["Junior", "Middle", "Senior", "Lead"]
on_silver("D3_heatmap_wide", lambda s: rounded(gold.heatmap_wide(gold.heatmap_salary(s), LEVELS), *LEVELS))
on_silver("D4_drill_down", lambda s: gold.drill_down(s, {"work_mode": ["Remote", "Hybrid"]}, ["job_id", "title", "work_mode"]))

# --- n-grams ------------------------------------------------------------------------------------


@query("N1_tokens")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(ngrams.tokens(F.col("text")), " ").alias("tokens"))


@query("N2_ngram_counts")
def _(spark, sf_dir):
    return ngrams.ngram_counts(table(spark, sf_dir, "documents"), F.col("text"))


@query("N3_candidates")
def _(spark, sf_dir):
    return ngrams.candidates(ngrams.ngram_counts(table(spark, sf_dir, "documents"), F.col("text")))


on_postings("N4_combined_text", lambda: [ngrams.combined_text(F.col("description"), F.col("requirements")).alias("text")])


@query("N4_null_counts")
def _(spark, sf_dir):
    return ngrams.null_counts(postings(spark, sf_dir).select("salary", "requirements", "deadline"))


# --- quality ------------------------------------------------------------------------------------



def as_of():
    return F.lit("2000-01-01").cast("timestamp")


on_silver("C1_completeness", quality.completeness)
on_silver("V1_validity", quality.validity)
on_silver("A1_accuracy", quality.accuracy)
on_silver("U_uniqueness", quality.uniqueness)
on_silver(
    "U2_role_mismatch",
    lambda s: s.select(
        "job_url", "normalized_role", quality.role_mismatch(F.col("normalized_role"), F.col("title")).alias("reason")
    ).filter("reason IS NOT NULL"),
)


@query("U1_duplicate_keys")
def _(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "events"), "user_id")


@query("T1_timeliness")
def _(spark, sf_dir):
    end = F.lit("2024-01-31").cast("timestamp")
    return quality.timeliness(table(spark, sf_dir, "events"), end, column="ts")


THREE = ["completeness", "validity", "accuracy"]
on_silver("R1_stage_selection", lambda s: quality.run_stages(s, quality.stages(as_of()), ["validity", "unknown"]))


@query("R2_run_time_isolation")
def _(spark, sf_dir):
    """A stage that fails while it runs, beside others of the same pass."""
    late = quality.Checks("late", lambda df: {"x": F.count_if(F.raise_error(F.lit("late")).isNull())}, F.lit("OK"))
    return quality.run_stages(silver_of(spark, sf_dir), {"late": late, "validity": quality.validity_checks()})


@query("R2_stage_isolation")
def _(spark, sf_dir):
    def broken(df: DataFrame) -> DataFrame:
        return df.select("no_such_column")

    return quality.run_stages(silver_of(spark, sf_dir), {"broken": broken, "validity": quality.validity})


on_silver("R3_gate", lambda s: quality.gate(quality.run_stages(s, quality.stages(as_of()), THREE)))
on_silver("R4_summary", lambda s: quality.summary(quality.run_stages(s, quality.stages(as_of()), THREE)))


@query("R5_violation_sample")
def _(spark, sf_dir):
    rows = quality.violations(silver_of(spark, sf_dir), quality.accuracy_rules(), ["exp_min", "exp_max"])
    return quality.violation_sample(rows)


# --- sources and sinks --------------------------------------------------------------------------


@query("S1_read_records")
def _(spark, sf_dir):
    path = scratch_path(spark, "records")
    postings(spark, sf_dir).select("title", "company", "location", "salary", "experience", "url").write.json(path)
    return io.read_records(spark, path, schemas.LISTING, multi_line=False)


@query("S1_read_arrays")
def _(spark, sf_dir):
    """Files of one array each, read by splits."""
    path = scratch_path(spark, "arrays")
    record = F.to_json(F.struct("title", "company", "location", "salary", "experience", "url"))
    arrays = postings(spark, sf_dir).groupBy(F.floor(F.col("ord") / 5000).alias("part")).agg(F.collect_list(record).alias("records"))
    text = F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]"))
    arrays.select("part", text.alias("value")).write.partitionBy("part").text(path)
    return io.read_records(spark, path, schemas.LISTING, whole_file_bytes=0)


@query("S2_read_silver")
def _(spark, sf_dir):
    path = scratch_path(spark, "silver") + ".parquet"
    io.write_silver(silver_of(spark, sf_dir), path)
    return io.read_silver(spark, path).select("job_id", "normalized_role", "salary_max", joined("skills"))


@query("S3_read_by_suffix")
def _(spark, sf_dir):
    path = scratch_path(spark, "silver") + ".csv"
    io.write_silver(silver_of(spark, sf_dir), path, "csv")
    return io.read_table(spark, path).select("job_id", "normalized_role", "skills")


@query("S4_write_silver")
def _(spark, sf_dir):
    path = scratch_path(spark, "silver")
    io.write_silver(silver_of(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("currency").agg(F.count("*").alias("n"))


def written_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    io.write_silver(silver_of(spark, sf_dir), path)
    return io.read_silver(spark, path)


@query("S5_gold_rows")
def _(spark, sf_dir):
    """All nine tables, written and read again: rows of each, and what its numbers add up to."""
    path = scratch_path(spark, "gold")
    tables = gold.build_gold(written_silver(spark, sf_dir))
    io.write_gold(tables, path)
    rows = []
    for name, df in io.read_gold(spark, path, {n: t.schema for n, t in tables.items()}).items():
        number = "count" if "count" in df.columns else "total_jobs" if "total_jobs" in df.columns else "salary_max_mean"
        rows.append(df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.round(F.sum(F.col(number).cast("double")), 3).alias("sum")))
    return reduce(DataFrame.unionByName, rows)


@query("S5_write_gold")
def _(spark, sf_dir):
    path = scratch_path(spark, "gold")
    tables = gold.build_gold(written_silver(spark, sf_dir))
    io.write_gold(tables, path)
    back = io.read_gold(spark, path, {n: t.schema for n, t in tables.items()})
    return back["salary_by_role"].select("normalized_role", F.round("salary_max_mean", 6).alias("salary_max_mean"))


def long_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """All rows of all tables: table, the text columns' values, a row's numbers."""
    rows = []
    for name, df in tables.items():
        texts = [c for c, kind in df.dtypes if kind == "string"]
        numbers = [c for c in df.columns if c not in texts]
        rows.append(
            df.select(
                F.lit(name).alias("name"),
                F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in texts]).alias("keys"),
                F.round(F.col(numbers[0]).cast("double"), 6).alias("number"),
                F.round((F.col(numbers[1]) if len(numbers) > 1 else F.lit(None)).cast("double"), 6).alias("more"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


@query("G_kept_up_to_date")
def _(spark, sf_dir):
    """All nine tables, row for row, from partial aggregates of three Silver batches, one of them given twice."""
    store, whole = scratch_path(spark, "gold_parts"), written_silver(spark, sf_dir)
    year = F.coalesce(F.substring("crawled_at", 1, 4), F.lit("")).cast("string")
    early, middle = year < "1994", (year >= "1994") & (year < "1996")
    gold_parts.put_batch(whole.filter(early | middle), store, "early")
    for name, rows in (("early", early), ("middle", middle), ("late", ~early & ~middle)):
        gold_parts.put_batch(whole.filter(rows), store, name)
    return long_rows(gold_parts.read_tables(spark, store))


@query("S6_append_landing")
def _(spark, sf_dir):
    path = scratch_path(spark, "landing")
    p = postings(spark, sf_dir).select("id", "title", "url", "crawled_at")
    for _ in range(2):  # no deduplication: both runs stay
        io.append_landing(p, path, F.substring("crawled_at", 1, 4), F.coalesce(N.normalize_role(F.col("title")), F.lit("other")), "parquet")
    return spark.read.parquet(path).groupBy("crawl_date", "role").agg(F.count("*").alias("n"))


@query("S6_land_once")
def _(spark, sf_dir):
    """Two runs, one of them given twice, in files by size."""
    path = scratch_path(spark, "landing")
    p = postings(spark, sf_dir).select("id", "title", "url", "crawled_at")
    for run in ("first", "second", "first"):
        landing.land(p, path, F.substring("crawled_at", 1, 4), N.normalize_role(F.col("title")), run, "parquet", rows_per_file=5000)
    return landing.read_landing(spark, path).select("run", "crawl_date", "role", "id", "title", "url")


@query("S7_read_pages")
def _(spark, sf_dir):
    path = scratch_path(spark, "html")
    table(spark, sf_dir, "pages").select(F.regexp_replace("html", r"\s+", " ").alias("value")).write.text(path)
    return io.read_pages(spark, path).agg(F.sum(F.length(F.replace(F.col("html"), F.lit("\n"), F.lit("")))).alias("chars"), (F.count("url") > 0).alias("named"))


@query("S8_read_gold")
def _(spark, sf_dir):
    path = scratch_path(spark, "gold")
    tables = gold.build_gold(silver_of(spark, sf_dir))
    io.write_gold({"top_skills": tables["top_skills"]}, path)
    back = io.read_gold(spark, path, {n: tables[n].schema for n in ("top_skills", "top_domains")})
    io.register_views(back)
    return spark.sql("SELECT skill AS item, count FROM top_skills UNION ALL SELECT domain, count FROM top_domains")


@query("S9_dataset_status")
def _(spark, sf_dir):
    names = ["documents", "pages", "orders"]
    return io.dataset_status({n: table(spark, sf_dir, n) for n in names}).select("dataset", "present", "rows")


@query("S10_write_report")
def _(spark, sf_dir):
    path = scratch_path(spark, "report")
    report(spark, sf_dir, path)
    return spark.read.json(f"{path}/2000-01-01/violations_*.json").groupBy("check").agg(F.count("*").alias("n"))


def report(spark: SparkSession, sf_dir: str, path: str) -> None:
    s = written_silver(spark, sf_dir)
    results = quality.run_stages(s, quality.stages(as_of()))
    found = quality.violations(s, quality.accuracy_rules(), ["salary_min", "salary_max"])
    code = quality.gate(results).first().exit_code
    io.write_report(results, found, path, "2000-01-01T10:20:30", "silver", s.count(), code)


@query("S10_report_results")
def _(spark, sf_dir):
    path = scratch_path(spark, "report")
    report(spark, sf_dir, path)
    marked = spark.read.json(f"{path}/2000-01-01/report_2000-01-01_10-20-30.json")
    return marked.select(*quality.RESULT, "timestamp", "source", "total_records", "exit_code", "stages")


@query("S10_report_markdown")
def _(spark, sf_dir):
    path = scratch_path(spark, "report")
    report(spark, sf_dir, path)
    lines = spark.read.text(f"{path}/2000-01-01/report_2000-01-01_10-20-30.md")
    cells = F.split("value", r" \| ")
    rows = lines.filter(F.col("value").startswith("| ") & ~F.col("value").startswith("| -") & ~F.col("value").startswith("| stage"))
    return rows.select(F.substring(cells[0], 3, 99).alias("stage"), cells[1].alias("check"), cells[2].cast("long").alias("count"))
