"""Synthetic postings, derived from ``orders`` and ``customer``: one per order.

The expressions are SQL that Spark and DuckDB share; only picking from a list is spelled for each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TITLES = [
    "Senior Data Engineer", "Data Analyst", "Data Scientist (Middle)", "BI Analyst", "Machine Learning Engineer",
    "AI Engineer", "Data Manager", "Data Quality Specialist", "Junior Data Analyst", "Data Solution Architect", "DBA",
    "Data Platform Engineer", "Lead Analytics Engineer", "ETL Developer", "Data Engineer Intern", "Kế toán trưởng",
]
LOCATIONS = [
    "Hà Nội", "Hồ Chí Minh (mới)", "Việc làm tại Đà Nẵng", "Hà Nội & Hồ Chí Minh", "Hải Phòng, Hà Nội", "Tokyo",
    "Cần Thơ - Hậu Giang", "tp.hcm", "Bà Rịa - Vũng Tàu", "  Bình Dương  ", "(mới)", "Saigon | Hanoi",
]
EXPERIENCES = [
    "3 năm", "Trên 5 năm", "Dưới 1 năm", "Không yêu cầu", "2 - 5 năm", "5+ năm", "Fresher", "tuỳ vị trí", "2-3", "7",
    "20 năm",
]
TEXTS = [
    "Build pipelines with Python, Spark and SQL.", "Use Power  BI, Excel and SQL Server for banking.",
    "Need C++ and C# with CI/CD; remote work.", "Data warehouse and data lakehouse on AWS S3.",
    "Hybrid role: machine learning, ML, scikit-learn.", "Yêu cầu rõ ràng, làm việc tại văn phòng.",
    "Kafka streaming, near real-time fintech.", "Tableau and statistics; work from home.",
    "AI models, LLM and genai for ecommerce.", "Airflow, dbt, Docker, data governance.",
]
TIMES = ["Thứ 2 - Thứ 6 (từ 08:30 đến 17:30)", "Onsite", "WFH", "", "Hybrid"]
SCHEDULES = ["Toàn thời gian", "Part-time", "Thực tập", "Freelance"]

Pick = Callable[[list[str], str], str]


def _quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def spark_pick(values: list[str], index: str) -> str:
    return f"element_at(array({_quoted(values)}), cast({index} as int) + 1)"


def duckdb_pick(values: list[str], index: str) -> str:
    return f"list_extract([{_quoted(values)}], cast({index} as int) + 1)"


def posting_columns(pick: Pick, date: str) -> list[str]:
    """Columns over k (order key), u (customer key), c_name; ``date``: the order date as yyyy-mm-dd."""
    salary = f"""CASE k % 11
        WHEN 0 THEN 'Thoả thuận'
        WHEN 1 THEN concat(cast(k % 30 + 10 as string), ' - ', cast(k % 30 + 25 as string), ' triệu')
        WHEN 2 THEN concat('Tới ', cast(k % 40 + 8 as string), '.5 triệu')
        WHEN 3 THEN '10,000,000 - 20,000,000 VND'
        WHEN 4 THEN concat('800 - 3,', cast(k % 9 + 1 as string), '00 USD')
        WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN '1.500.000' WHEN 8 THEN 'Cạnh tranh' WHEN 9 THEN 'Lương, thưởng'
        ELSE concat(cast(k % 600 as string), ' triệu') END"""
    return [
        "k AS ord",
        "cast(k as string) AS id",
        "concat('https://jobs.example.test/viec-lam/', cast(k as string), '.html', CASE WHEN k % 3 = 0 THEN '?src=a' ELSE '' END) AS url",
        f"{pick(TITLES, 'k % 16')} AS title",
        "c_name AS company",
        f"{pick(LOCATIONS, 'u % 12')} AS location",
        f"{salary} AS salary",
        f"{pick(EXPERIENCES, 'u % 11')} AS experience",
        f"{pick(TEXTS, 'k % 10')} AS description",
        f"CASE WHEN k % 4 = 0 THEN NULL ELSE {pick(TEXTS, '(k + 3) % 10')} END AS requirements",
        "cast(NULL as string) AS benefits",
        f"{pick(TIMES, 'u % 5')} AS working_time",
        f"{pick(SCHEDULES, 'k % 4')} AS job_type",
        f"CASE WHEN k % 50 = 0 THEN '31/12/2026' WHEN k % 7 = 0 THEN NULL ELSE {date} END AS deadline",
        f"{date} AS crawled_at",
        "cast(NULL as string) AS level",
        "cast(NULL as int) AS number_of_hires",
        "cast(NULL as string) AS source",
    ]


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per order that has a customer.

    The narrow rows are dealt out evenly before they become wide: a small file is one split, and the
    work on postings would be one task.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).selectExpr(
        "o_orderkey AS k", "o_custkey AS u", "c_name", "o_orderdate"
    )
    return joined.repartition(n, "k").selectExpr(*posting_columns(spark_pick, "date_format(o_orderdate, 'yyyy-MM-dd')"))


#: The same as a DuckDB table expression named ``postings``.
POSTINGS_CTE = (
    "base AS (SELECT o_orderkey AS k, o_custkey AS u, c_name, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey),\n"
    f"postings AS (SELECT {', '.join(posting_columns(duckdb_pick, "strftime(o_orderdate, '%Y-%m-%d')"))} FROM base)"
)


def merge_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three overlapping sources (list, detail, text) cut from the postings, with planted blanks."""
    p = postings(spark, sf_dir)
    listed = p.filter("ord % 5 <> 0").selectExpr(
        "ord", "title", "company", "location", "CASE WHEN ord % 2 = 0 THEN '  ' ELSE salary END AS salary", "experience", "url"
    )
    detail = p.filter("ord % 3 <> 0").selectExpr(
        "ord", "id", "url", "split_part(url, '?', 1) AS normalized_url",
        "CASE WHEN ord % 7 = 0 THEN NULL ELSE title END AS title", "concat(company, '-d') AS company", "salary", "location",
        "experience", "deadline", "job_type", "working_time", "crawled_at",
    )
    text = p.filter("ord % 4 <> 1").selectExpr(
        "ord", "id", "url", "split_part(url, '?', 1) AS normalized_url", "title", "description", "requirements", "benefits", "crawled_at"
    )
    return listed, detail, text
