"""DuckDB SQL that gives the rows of the registered queries, written apart from the Spark code."""

from __future__ import annotations

import re

from .. import vocabulary as V
from ..operators.ngrams import STOPWORDS
from ..sources.postings import POSTINGS_CTE


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case(rules: list[tuple[str, str]], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {default} END"


def contains_case(text: str, rules: list[tuple[str, str]], default: str = "NULL") -> str:
    return case([(f"contains({text}, {q(k)})", v) for k, v in rules], default)


def matches_case(text: str, rules: list[tuple[str, str]], default: str = "NULL") -> str:
    return case([(f"regexp_matches({text}, {q(p)})", q(v)) for p, v in rules], default)


def keyword_list(text: str, words: list[str], unicode_borders: bool = False) -> str:
    """Sorted keywords of a text; RE2 has no look-around, so a border takes one character."""
    a, b = (r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])") if unicode_borders else ("(^|[^a-z0-9])", "($|[^a-z0-9])")

    def pattern(w: str) -> str:
        return a + (w if unicode_borders else r"\s+".join(re.escape(p) for p in w.split(" "))) + b

    found = ", ".join(f"CASE WHEN regexp_matches({text}, {q(pattern(w))}) THEN {q(w)} END" for w in sorted(set(words)))
    return f"list_sort(list_filter([{found}], lambda x: x IS NOT NULL))"


CITY_RULES = [(k, q(city)) for city, names in V.CITIES.items() for k in names]
SKILL_WORDS = [w for w in V.SKILLS if w not in set(V.DOMAINS)]
YEAR_RULES = [(f"exp_min BETWEEN {a} AND {b}", q(n)) for a, b, n in V.YEARS]
NUMBER = r"(\d+(?:\.\d+)?)"


def years(pattern: str, group: int = 1) -> str:
    return f"CAST(trunc(try_cast(regexp_extract(x, {q(pattern)}, {group}) AS DOUBLE)) AS INTEGER)"


def _experience() -> tuple[str, str]:
    over, under = rf"trên\s*{NUMBER}\s*năm", rf"dưới\s*{NUMBER}\s*năm"
    units, plain = rf"{NUMBER}\s*[-–—]\s*{NUMBER}\s*(?:năm|year|yr)", r"(\d+)\s*[-–—]\s*(\d+)"
    one, only = rf"{NUMBER}\s*(?:\+|trở lên|năm|year|yr)", rf"^{NUMBER}$"
    open_ended = "(contains(x, '+') OR contains(x, 'trở lên'))"

    def m(p: str) -> str:
        return f"regexp_matches(x, {q(p)})"

    rules = [
        ("experience IS NULL OR experience = ''", "NULL", "NULL"),
        (m("không yêu cầu|không|none|no experience"), "0", "NULL"),
        (m(over), years(over), "NULL"),
        (m(under), "0", years(under)),
        (m(units), years(units), years(units, 2)),
        (m(plain), years(plain), years(plain, 2)),
        (m(one), years(one), f"CASE WHEN NOT {open_ended} THEN {years(one)} END"),
        (m(only), years(only), years(only)),
        (m("fresher|intern|mới ra trường"), "0", "0"),
    ]
    return tuple(f"CAST({case([(r[0], r[k]) for r in rules])} AS INTEGER)" for k in (1, 2))


EXP_MIN, EXP_MAX = _experience()


def _scaled(v: str) -> str:
    return f"round(CASE WHEN unit = 'VND' AND {v} > 1000 THEN {v} / 1000000 ELSE {v} END, 1)"


#: parsed: every posting with its normalised columns, good or not; silver: the good ones.
SILVER_CTE = f"""{POSTINGS_CTE},
step1 AS (
  SELECT *, trim(location) AS loc0, lower(trim(experience)) AS x, trim(salary) AS s0,
    CASE WHEN contains(lower(trim(salary)), 'usd') THEN 'USD' ELSE 'VND' END AS unit,
    lower(concat_ws(' ', nullif(title, ''), nullif(description, ''), nullif(requirements, ''))) AS words,
    lower(concat_ws(' ', nullif(working_time, ''), nullif(description, ''), nullif(requirements, ''))) AS mode_words
  FROM postings
), step2 AS (
  SELECT *, CASE WHEN starts_with(loc0, 'Việc làm tại ') THEN replace(loc0, 'Việc làm tại ', '') ELSE loc0 END AS loc1,
    regexp_extract_all(regexp_replace(regexp_replace(s0, 'thưởng|bonus|upto|up to|~|khoảng|tr\\.|triệu|đồng|\\$', '', 'gi'), '[^0-9,.\\-–—]', ' ', 'g'), '([\\d,]+\\.?\\d*)', 1) AS tokens,
    regexp_matches(s0, 'thoả thuận|thương lượng|negotiable|négociable', 'i') AS offered,
    {EXP_MIN} AS exp_min, {EXP_MAX} AS exp_max
  FROM step1
), step3 AS (
  SELECT *, {case([(f"contains(loc1, {q(s)})", f"trim(split_part(loc1, {q(s)}, 1))") for s in (" & ", " | ", " / ", ", ", " - ")], "loc1")} AS loc2,
    list_transform(tokens, lambda t: try_cast(replace(t, ',', '') AS DOUBLE)) AS nums,
    coalesce(salary, '') = '' AS no_salary
  FROM step2
), step4 AS (
  SELECT *, trim(regexp_replace(loc2, '\\s*\\([^)]*\\)\\s*', ' ', 'g')) AS loc3,
    NOT no_salary AND NOT offered AND len(list_filter(nums, lambda v: v IS NULL)) > 0 AS bad,
    NOT no_salary AND NOT offered AND len(tokens) > 0 AS parsed_numbers
  FROM step3
), parsed AS (
  SELECT ord, id AS job_id, 'TopCV' AS source, url AS job_url, title, company, location AS location_raw,
    coalesce({contains_case("lower(loc3)", CITY_RULES)}, loc3) AS location_clean,
    CASE WHEN parsed_numbers AND NOT bad AND len(tokens) > 1 THEN {_scaled("list_min(nums)")} END AS salary_min,
    CASE WHEN parsed_numbers AND NOT bad THEN {_scaled("list_max(nums)")} END AS salary_max,
    CASE WHEN parsed_numbers AND NOT bad THEN unit END AS currency,
    NOT no_salary AND (offered OR len(tokens) = 0) AS is_negotiable,
    exp_min, exp_max, deadline, CAST(NULL AS VARCHAR) AS level, CAST(NULL AS INTEGER) AS number_of_hires,
    {case([(f"job_type = {q(k)}", q(v)) for k, v in V.SCHEDULES.items()])} AS job_schedule_type, working_time,
    'Vietnam' AS job_country,
    {contains_case("mode_words", [(k, q(m)) for k, m, _ in V.WORK_MODES], "'Onsite'")} AS work_mode,
    {contains_case("mode_words", [(k, str(h).lower()) for k, _, h in V.WORK_MODES], "false")} AS job_work_from_home,
    coalesce({matches_case("lower(title)", V.SENIORITY)}, {case(YEAR_RULES)}, 'Unknown') AS seniority_level,
    {matches_case("lower(title)", V.ROLES)} AS normalized_role,
    description, requirements, benefits,
    {keyword_list("words", SKILL_WORDS)} AS skills,
    {keyword_list("words", V.DOMAINS, True)} AS domain_keywords,
    crawled_at, bad
  FROM step4
), silver AS (SELECT * FROM parsed WHERE NOT bad)"""


def silver(body: str) -> str:
    return f"WITH {SILVER_CTE}\n{body}"


def postings(body: str) -> str:
    return f"WITH {POSTINGS_CTE}\n{body}"


def _mean(column: str, name: str) -> str:
    return f"round(avg({column}), 6) AS {name}"


def _counts(column: str, name: str, limit: int | None = None, table: str = "silver") -> str:
    tail = f" ORDER BY count DESC, {name} LIMIT {limit}" if limit else ""
    return f"SELECT {column} AS {name}, count(*) AS count FROM {table} WHERE {column} IS NOT NULL GROUP BY 1{tail}"


def _checks(stage: str, checks: dict[str, str], status: str) -> str:
    """One row per check over ``silver``; ``checks``: name -> condition counted."""
    rows = " UNION ALL ".join(
        f"SELECT {q(n)} AS \"check\", count(*) FILTER (WHERE {c}) AS count, count(*) AS total FROM silver" for n, c in checks.items()
    )
    return silver(
        f", checks AS ({rows}) SELECT {q(stage)} AS stage, \"check\", count, total, round(count * 100.0 / total, 2) AS percentage, {status} AS status FROM checks WHERE total > 0"
    )


NOT_BLANK = "coalesce(trim({0}), '') <> ''"
COMPLETE = {c: NOT_BLANK.format(c) for c in ("title", "company", "location_clean", "normalized_role")} | {
    "salary_min": "salary_min IS NOT NULL",
    "salary_max": "salary_max IS NOT NULL",
    "skills": "len(skills) > 0",
    "deadline": "deadline IS NOT NULL",
}
COMPLETE_STATUS = (
    "CASE WHEN count / total >= 0.95 THEN 'OK' WHEN count / total >= "
    "CASE WHEN \"check\" IN ('salary_min', 'salary_max') THEN 0.25 ELSE 0.8 END THEN 'WARNING' ELSE 'ERROR' END"
)
VALID = {
    "salary_min_le_max": "salary_min > salary_max",
    "exp_min_le_max": "exp_min > exp_max",
    "valid_currency": "currency NOT IN ('VND', 'USD')",
    "valid_work_mode": "work_mode NOT IN ('Onsite', 'Hybrid', 'Remote')",
    "valid_seniority": "seniority_level NOT IN ('Junior', 'Middle', 'Senior', 'Lead', 'Unknown')",
    "valid_deadline": "deadline IS NOT NULL AND try_strptime(deadline, '%Y-%m-%d') IS NULL",
}
VALID_STATUS = "CASE WHEN count <= 5 THEN 'OK' WHEN count <= 15 THEN 'WARNING' ELSE 'ERROR' END"
KNOWN = "(salary_min IS NOT NULL OR salary_max IS NOT NULL)"
ACCURATE = {
    "accurate_negotiable_salary": f"is_negotiable AND {KNOWN}",
    "accurate_missing_salary": f"NOT is_negotiable AND NOT {KNOWN}",
    "outlier_salary_vnd": "currency = 'VND' AND (salary_min > 500 OR salary_max > 500)",
    "outlier_salary_usd": "currency = 'USD' AND (salary_min > 20000 OR salary_max > 20000)",
    "outlier_experience": "exp_min > 15 OR exp_max > 15",
}
ACCURATE_STATUS = "CASE WHEN count = 0 THEN 'OK' ELSE 'WARNING' END"
MISMATCH = (
    "normalized_role IS NOT NULL AND title IS NOT NULL AND NOT coalesce("
    + case([(f"normalized_role = {q(r)}", "(" + " OR ".join(f"contains(lower(title), {q(w)})" for w in ws) + ")") for r, ws in V.ROLE_WORDS.items()], "false")
    + ", false)"
)
MERGE_CTE = f"""{POSTINGS_CTE},
listed AS (SELECT ord, title, company, location, CASE WHEN ord % 2 = 0 THEN '  ' ELSE salary END AS salary, experience, split_part(url, '?', 1) AS k FROM postings WHERE ord % 5 <> 0),
detail AS (SELECT ord, id, CASE WHEN ord % 7 = 0 THEN NULL ELSE title END AS title, concat(company, '-d') AS company, location, salary, experience, deadline, job_type, working_time, crawled_at, split_part(url, '?', 1) AS k FROM postings WHERE ord % 3 <> 0),
texts AS (SELECT ord, description, requirements, benefits, crawled_at, split_part(url, '?', 1) AS k FROM postings WHERE ord % 4 <> 1),
stacked AS (
  SELECT k, ord AS o, NULL AS id, title, company, location, salary, experience, NULL AS deadline, NULL AS job_type, NULL AS working_time, NULL AS crawled_at, NULL AS description, NULL AS requirements, NULL AS benefits FROM listed
  UNION ALL SELECT k, ord + 1000000000, id, title, company, location, salary, experience, deadline, job_type, working_time, crawled_at, NULL, NULL, NULL FROM detail
  UNION ALL SELECT k, ord + 2000000000, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, crawled_at, description, requirements, benefits FROM texts
), merged AS (
  SELECT k AS normalized_url, k AS url, {", ".join(f"arg_min({c}, o) FILTER (WHERE trim({c}) <> '') AS {c}" for c in ("id", "title", "company", "location", "salary", "experience", "deadline", "job_type", "working_time", "crawled_at", "description", "requirements", "benefits"))}
  FROM stacked GROUP BY k
)"""
PAGE_KEYS = "SELECT page_id, nullif(split_part(url, '?', 1), '') AS key, url, html FROM pages"
SPLIT = f"old AS (SELECT * FROM ({PAGE_KEYS}) WHERE page_id % 3 <> 0), new AS (SELECT * FROM ({PAGE_KEYS}) WHERE page_id % 2 = 0 OR page_id % 3 = 0)"
#: The new side with repeats of its keys, and rows without one.
ARRIVALS = "SELECT page_id, key FROM new UNION ALL SELECT page_id + 1000000000, CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '' ELSE key END FROM new"


def _added(arrivals: str) -> str:
    """Row by row as they arrive: one without a key is passed over, one whose key is there already, too."""
    return (
        f"WITH {SPLIT}, arriving AS ({arrivals}), added AS (SELECT page_id, key FROM (SELECT page_id, key, row_number() OVER (PARTITION BY key ORDER BY page_id) AS n "
        "FROM arriving WHERE key IS NOT NULL AND key <> '' AND NOT EXISTS (SELECT 1 FROM old WHERE old.key = arriving.key)) WHERE n = 1)"
    )


def insert_only_sql(arrivals: str) -> str:
    return _added(arrivals) + " SELECT page_id, key, 'old' AS side FROM old UNION ALL SELECT page_id, key, 'new' FROM added"


def insert_counts_sql(arrivals: str) -> str:
    return _added(arrivals) + " SELECT (SELECT count(*) FROM old) + (SELECT count(*) FROM added) AS total, (SELECT count(*) FROM added) AS added"


DOC_WORDS = ["ai", "r", "license", "the", "public license", "in", "cc by", "c++"]
TOKENS = (
    "list_transform(list_filter(regexp_extract_all(text, '[A-Za-z0-9]+(?:[-_][A-Za-z0-9]+)*'), lambda t: len(t) > 2 AND t NOT IN ("
    + ", ".join(q(w) for w in dict.fromkeys(STOPWORDS))
    + ")), lambda t: lower(t))"
)
GRAMS = (
    f"WITH t AS (SELECT {TOKENS} AS w FROM documents), g AS ("
    + " UNION ALL ".join(
        f"SELECT unnest(list_transform(range(1, len(w) - {n - 1} + 1), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS gram FROM t" for n in (1, 2, 3)
    )
    + "), n AS (SELECT gram, count(*) AS count FROM g GROUP BY 1 HAVING count(*) >= 3)"
)
#: Pages made of postings; the same SQL text in both engines.
JOB_PAGE = """concat('<html><head><title>', title, ' | 404 jobs</title><style>p{}</style></head><body><nav>Menu</nav><h1>', title, '</h1>',
  CASE ord % 4
    WHEN 0 THEN concat('<script type="application/ld+json">{"@type":"JobPosting","baseSalary":{"currency":"USD","value":{"minValue":', cast(ord % 50 + 10 as string), ',"maxValue":', cast(ord % 50 + 60 as string), ',"unitText":"MONTH"}}}</script>')
    WHEN 1 THEN concat('<div class="item"><strong>Salary</strong> ', cast(ord % 90 + 10 as string), ' - ', cast(ord % 90 + 200 as string), ' USD</div>')
    WHEN 2 THEN concat('<p>We pay $', cast(ord % 90 + 10 as string), ' - ', cast(ord % 90 + 200 as string), ' USD a month</p>')
    ELSE '<p>Competitive pay</p>' END,
  '<h2>Mô tả công việc</h2><p>', description, '</p><p>Join us.</p><h2>Yêu cầu ứng viên</h2><ul><li>At least ', cast(ord % 9 + 1 as string),
  ' years of experience in data</li></ul><h3>Quyền lợi</h3><p>', company, '</p><div class="info-item"><b class="label">Cấp bậc</b><span class="value">', coalesce(job_type, ''), '</span></div>',
  '<div class="job-card"><h3><a href="/viec/', id, '">', title, '</a></h3><span class="company">', company, '</span><span class="salary">', CASE WHEN ord % 4 = 3 THEN '' ELSE coalesce(salary, '') END, '</span></div>',
  CASE WHEN ord % 2 = 0 THEN '<a rel="next" href="?p=2">next</a>' ELSE '' END, '<footer>Foot</footer></body></html>')"""
COLLAPSED = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
SQUASH = COLLAPSED.format("description")

#: A label on every fourth page; else the first pair of numbers with a currency in the page's text: what
#: the page offers, or its listing card's salary in millions.
HTML_SALARY = postings(
    """SELECT ord, CASE kind WHEN 0 THEN NULL WHEN 3 THEN concat(low, ' - ', high, ' triệu') WHEN 2 THEN concat('$', low, ' - ', high, ' USD') ELSE concat(low, ' - ', high, ' USD') END AS salary_text,
    CAST(low AS DOUBLE) AS salary_min, CAST(high AS DOUBLE) AS salary_max,
    CASE kind WHEN 0 THEN NULL WHEN 3 THEN 'VND' ELSE 'USD' END AS currency, CAST(NULL AS VARCHAR) AS unit,
    CASE kind WHEN 0 THEN NULL WHEN 1 THEN 'html-label' ELSE 'html-pattern' END AS salary_source,
    CASE WHEN kind > 0 THEN false END AS is_negotiable
    FROM (SELECT ord, kind, CASE WHEN kind = 3 THEN ord % 30 + 10 WHEN kind > 0 THEN ord % 90 + 10 END AS low, CASE WHEN kind = 3 THEN ord % 30 + 25 WHEN kind > 0 THEN ord % 90 + 200 END AS high
      FROM (SELECT ord, CASE WHEN ord % 4 = 1 THEN 1 WHEN ord % 4 = 2 THEN 2 WHEN ord % 4 = 0 AND ord % 11 = 1 THEN 3 ELSE 0 END AS kind FROM postings))"""
)

ORACLES: dict[str, str] = {
    "P1_clean_location": silver("SELECT ord, location_clean FROM parsed"),
    "P2_parse_experience": silver("SELECT ord, exp_min, exp_max FROM parsed"),
    "P3_parse_salary": silver("SELECT ord, salary_min, salary_max, currency, CASE WHEN bad THEN false ELSE is_negotiable END AS is_negotiable, bad AS bad_number FROM parsed"),
    "P4_extract_skills": silver("SELECT ord, array_to_string(skills, ',') AS skills FROM parsed"),
    "P4_skills_documents": f"SELECT doc_id, array_to_string({keyword_list('lower(text)', DOC_WORDS)}, ',') AS found FROM documents",
    "P5_extract_domains": silver("SELECT ord, array_to_string(domain_keywords, ',') AS domains FROM parsed"),
    "P5_domains_documents": f"SELECT doc_id, array_to_string({keyword_list('lower(text)', ['ai', 'r', 'license', 'the', 'public license', 'in'], True)}, ',') AS found FROM documents",
    "P6_normalize_role": silver("SELECT ord, normalized_role FROM parsed"),
    "P7_derive_seniority": silver("SELECT ord, seniority_level FROM parsed"),
    "P8_work_mode": silver("SELECT ord, work_mode, job_work_from_home FROM parsed"),
    "P9_schedule_type": silver("SELECT ord, job_schedule_type FROM parsed"),
    "P10_silver": silver("SELECT * EXCLUDE (ord, bad, skills, domain_keywords), array_to_string(skills, ',') AS skills, array_to_string(domain_keywords, ',') AS domain_keywords FROM silver"),
    "P11_rejects": silver("SELECT job_id, job_url, 'salary: number token without a digit' AS reject_reason FROM parsed WHERE bad"),
    "P12_typed_record": silver("SELECT job_id, CAST(strptime(crawled_at, '%Y-%m-%d') AS TIMESTAMP) AS crawled_at, array_to_string(list_filter(list_transform(string_split(title, ' '), lambda x: trim(x)), lambda x: x <> ''), '|') AS skills FROM parsed"),
    "P13_iso_text": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0') || 'Z' AS iso FROM events",
    "P14_parse_list": silver("SELECT ord, array_to_string(skills, ',') AS items, CAST(len(skills) AS INTEGER) AS n FROM parsed"),
    "P15_deadline": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS deadline FROM orders",
    "P16_first_integer": postings("SELECT ord, CAST(ord AS INTEGER) AS n FROM postings"),
    "P17_fill_city": postings("SELECT ord, CASE WHEN ord % 3 = 0 THEN coalesce(nullif(regexp_extract(location, 'Hà Nội|Hồ Chí Minh|Đà Nẵng|Hải Phòng|Cần Thơ', 0), ''), '') ELSE location END AS city FROM postings"),
    "P18_collapse_spaces": r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents",
    "P19_salary_noise": postings("SELECT ord, CASE WHEN ord % 4 = 0 THEN '' ELSE salary END AS salary FROM postings"),
    "P20_salary_with_unit": postings("SELECT ord, CASE WHEN ord % 3 = 0 THEN NULL ELSE CAST(ord % 900 + 100 AS DOUBLE) END AS salary_min, CAST(CASE WHEN ord % 3 = 1 THEN ord % 900 + 1100 ELSE ord % 900 + 100 END AS DOUBLE) AS salary_max, 'USD' AS currency, CASE WHEN ord % 2 = 0 THEN 'YEAR' ELSE 'MONTH' END AS unit, false AS is_negotiable FROM postings"),
    "P21_salary_text_valid": postings("SELECT ord, CASE ord % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN true ELSE false END AS valid FROM postings"),
    "P22_source_job_id": "SELECT page_id, 'itviec_' || CAST(page_id AS VARCHAR) AS job_id, CASE WHEN page_id % 2 = 0 THEN url ELSE 'https://jobs.example.test/it-jobs/' || CAST(page_id AS VARCHAR) END AS job_url FROM pages",
    "P23_salary_hidden": postings("SELECT ord, CASE WHEN ord % 6 = 0 THEN true ELSE coalesce(trim(salary) = '', true) END AS hidden FROM postings"),
    "M1_normalize_url": "SELECT page_id, nullif(split_part(url, '?', 1), '') AS normalized_url FROM pages",
    "M2_merge_keys": f"WITH {MERGE_CTE} SELECT DISTINCT k AS normalized_url FROM stacked",
    "M3_merge_sources": f"WITH {MERGE_CTE} SELECT * FROM merged",
    "M4_id_from_url": postings("SELECT ord, CASE WHEN ord % 2 = 0 THEN id ELSE nullif(regexp_extract(url, '/(\\d+)\\.html', 1), '') END AS id FROM postings"),
    "M5_defaults": f"WITH {MERGE_CTE} SELECT normalized_url, coalesce(id, regexp_extract(normalized_url, '/(\\d+)\\.html', 1)) AS id, coalesce(title, 'Job ' || coalesce(id, regexp_extract(normalized_url, '/(\\d+)\\.html', 1))) AS title, 'TopCV' AS source FROM merged",
    "M6_keep_first": f"SELECT page_id, key FROM (SELECT *, row_number() OVER (PARTITION BY regexp_extract(key, '^[a-z]+://([^/]+)', 1) ORDER BY page_id) AS n FROM ({PAGE_KEYS}) WHERE key IS NOT NULL) WHERE n = 1",
    "M7_insert_only": insert_only_sql(ARRIVALS),
    "M7_insert_counts": insert_counts_sql(ARRIVALS),
    "M7_insert_only_all": insert_only_sql("SELECT * FROM new"),
    "M7_insert_counts_all": insert_counts_sql("SELECT * FROM new"),
    **dict.fromkeys(["M8_overlay", "M8_overlay_files"], postings("SELECT ord, CASE WHEN ord % 2 = 0 THEN NULL ELSE company END AS company, CASE WHEN ord % 3 <> 0 THEN title END AS title, CASE WHEN ord % 2 = 0 THEN deadline END AS deadline FROM postings WHERE ord % 3 <> 0 OR ord % 2 = 0")),
    **{n: f"WITH {SPLIT} SELECT page_id, key FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.key = old.key)" for n in ("M9_pending", "M9_pending_all")},
    **{n: f"WITH {SPLIT} SELECT page_id, key FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.key = old.key) AND key IN (SELECT key FROM ({PAGE_KEYS}) WHERE page_id % 5 = 0 AND key IS NOT NULL)" for n in ("M10_resume", "M10_resume_all")},
    "M10_lost_checkpoint": f"WITH {SPLIT}, first AS (SELECT min(page_id) AS page_id, key FROM old WHERE key IS NOT NULL GROUP BY key) SELECT page_id, key AS normalized_url FROM first UNION ALL SELECT min(page_id), key FROM new WHERE key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM old WHERE old.key = new.key) GROUP BY key",
    "M11_repair_titles": postings("SELECT ord, title, CASE ord % 4 WHEN 0 THEN 'Tin tuyển dụng' WHEN 1 THEN company WHEN 2 THEN 'at topcv.vn' ELSE title END AS original_title FROM postings"),
    "M12_overlay_matched": silver("SELECT ord, company, salary_min, salary_max, salary_min IS NULL AND salary_max IS NULL AS salary_hidden FROM parsed WHERE ord % 3 <> 0 AND ord % 2 = 0"),
    "M13_run_summary": silver("SELECT normalized_role, count(*) FILTER (WHERE salary_max IS NOT NULL) AS found, count(*) FILTER (WHERE ord % 2 = 0) AS added, count(*) AS total, round(count(*) FILTER (WHERE salary_max IS NOT NULL) / count(*), 6) AS found_share, CASE WHEN bool_or(ord % 997 = 5) AND normalized_role LIKE 'Data%' THEN 'failed' ELSE 'success' END AS status, CASE WHEN bool_or(ord % 997 = 5) AND normalized_role LIKE 'Data%' THEN 'page not delivered' END AS error FROM parsed GROUP BY normalized_role"),
    "M13_run_exit_code": silver("SELECT count(*) FILTER (WHERE NOT bad) AS succeeded, count(*) FILTER (WHERE bad) AS failed, CAST(max(CAST(bad AS INTEGER)) AS INTEGER) AS exit_code FROM (SELECT coalesce(bool_or(ord % 997 = 5) AND normalized_role LIKE 'Data%', false) AS bad FROM parsed GROUP BY normalized_role)"),
    "M14_keyword_titles": postings("SELECT ord, title FROM postings WHERE contains(lower(title), 'data')"),
    "M15_valid_page": "SELECT page_id, CASE WHEN page_id % 7 = 0 THEN false WHEN page_id % 5 = 0 THEN false ELSE NOT regexp_matches(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '403|404|not found|forbidden|access denied') END AS valid FROM pages",
    "M16_union_listings": postings("SELECT id, title, company, url, CASE WHEN ord % 2 = 0 THEN NULL ELSE 'Hybrid' END AS work_mode, CASE WHEN ord % 2 = 0 THEN location END AS location FROM postings"),
    "H1_title_heading": r"SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, trim(regexp_replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&amp;', '&'), '\s+', ' ', 'g')) AS h1 FROM pages",
    "H2_sections": postings(f"SELECT ord, {SQUASH} || ' Join us.' AS description, 'At least ' || CAST(ord % 9 + 1 AS VARCHAR) || ' years of experience in data' AS requirements, company || ' Cấp bậc ' || job_type AS benefits FROM postings"),
    "H3_value_by_label": postings("SELECT ord, job_type AS job_level FROM postings"),
    "H4_listing_cards": postings(f"SELECT ord, title, company, '' AS location, '' AS experience, {COLLAPSED.format("CASE WHEN ord % 4 = 3 THEN '' ELSE coalesce(salary, '') END")} AS salary, 'https://jobs.example.test/viec/' || id AS url, ord % 2 = 0 AS has_next FROM postings"),
    "H5_json_ld_salary": postings("SELECT ord, CAST(ord % 50 + 10 AS VARCHAR) || ' - ' || CAST(ord % 50 + 60 AS VARCHAR) || ' USD' AS salary_text, CAST(ord % 50 + 10 AS DOUBLE) AS salary_min, CAST(ord % 50 + 60 AS DOUBLE) AS salary_max, 'USD' AS currency, 'MONTH' AS unit, 'json-ld' AS salary_source, false AS is_negotiable FROM postings WHERE ord % 4 = 0"),
    **dict.fromkeys(["H6_html_salary"], HTML_SALARY),
    "H6_html_salary_all": f"SELECT ord, salary_min, salary_max, salary_source FROM ({HTML_SALARY})",
    "H7_salary_cascade": postings("SELECT CASE ord % 4 WHEN 0 THEN 'json-ld' WHEN 1 THEN 'html-label' WHEN 2 THEN 'html-pattern' ELSE 'text-competitive' END AS salary_source, count(*) AS n FROM postings GROUP BY 1"),
    "H8_experience_snippet": postings("SELECT ord, 'At least ' || CAST(ord % 9 + 1 AS VARCHAR) || ' years of experience in data' AS snippet FROM postings"),
    **dict.fromkeys(["H9_brand_description", "H9_brand_description_all"], postings(f"SELECT ord, CASE WHEN length({SQUASH} || ' Join us.') > 50 THEN {SQUASH} || ' Join us.' ELSE '' END AS description FROM postings")),
    "H10_visible_text": postings(f"SELECT ord, trim(regexp_replace(concat(title, ' ', CASE ord % 4 WHEN 0 THEN '' WHEN 1 THEN concat('Salary ', CAST(ord % 90 + 10 AS VARCHAR), ' - ', CAST(ord % 90 + 200 AS VARCHAR), ' USD') WHEN 2 THEN concat('We pay $', CAST(ord % 90 + 10 AS VARCHAR), ' - ', CAST(ord % 90 + 200 AS VARCHAR), ' USD a month') ELSE 'Competitive pay' END, ' Mô tả công việc ', description, ' Join us. Yêu cầu ứng viên At least ', CAST(ord % 9 + 1 AS VARCHAR), ' years of experience in data Quyền lợi ', company, ' Cấp bậc ', job_type, ' ', title, ' ', company, ' ', CASE WHEN ord % 4 = 3 THEN '' ELSE coalesce(salary, '') END, CASE WHEN ord % 2 = 0 THEN ' next' ELSE '' END), '\\s+', ' ', 'g')) AS text FROM postings"),
    "G1_metrics": silver(f"SELECT count(*) AS total_jobs, {_mean('salary_max', 'avg_salary_max')}, (SELECT normalized_role FROM silver WHERE normalized_role IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_role, (SELECT location_clean FROM silver WHERE location_clean IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_location FROM silver"),
    "G2_salary_by_role": silver(f"SELECT normalized_role, {_mean('salary_min', 'salary_min_mean')}, {_mean('salary_max', 'salary_max_mean')} FROM silver WHERE normalized_role IS NOT NULL GROUP BY 1 HAVING avg(salary_min) IS NOT NULL AND avg(salary_max) IS NOT NULL"),
    "G3_salary_by_seniority": silver(f"SELECT seniority_level, {_mean('salary_max', 'salary_max_mean')} FROM silver WHERE seniority_level IS NOT NULL GROUP BY 1 HAVING avg(salary_max) IS NOT NULL"),
    "G4_heatmap_salary": silver(f"SELECT normalized_role, seniority_level, {_mean('salary_max', 'salary_max_mean')} FROM silver WHERE normalized_role IS NOT NULL AND seniority_level IS NOT NULL GROUP BY 1, 2 HAVING avg(salary_max) IS NOT NULL"),
    "G5_top_skills": silver(", s AS (SELECT unnest(skills) AS k FROM silver) " + _counts("k", "skill", 20, "s")),
    "G6_skills_by_role": silver(", s AS (SELECT normalized_role, unnest(skills) AS skills FROM silver WHERE normalized_role IS NOT NULL), n AS (SELECT normalized_role, skills, count(*) AS count, row_number() OVER (PARTITION BY normalized_role ORDER BY count(*) DESC, skills) AS r FROM s GROUP BY 1, 2) SELECT normalized_role, skills, count FROM n WHERE r <= 5"),
    "G7_location_distribution": silver(_counts("location_clean", "location")),
    "G8_work_mode_distribution": silver(_counts("work_mode", "work_mode")),
    "G9_top_domains": silver(", s AS (SELECT unnest(domain_keywords) AS k FROM silver) " + _counts("k", "domain", 15, "s")),
    "D1_filter_options": silver("SELECT DISTINCT normalized_role AS option FROM silver WHERE normalized_role IS NOT NULL"),
    "D2_selected_share": silver("SELECT count(*) FILTER (WHERE normalized_role IN ('Data Engineer', 'Data Analyst') AND location_clean IN ('Hà Nội', 'Đà Nẵng') AND seniority_level IN ('Junior', 'Senior')) AS selected, count(*) AS total FROM silver"),
    "D3_heatmap_wide": silver("SELECT normalized_role, " + ", ".join(f"round(avg(salary_max) FILTER (WHERE seniority_level = {q(s)}), 6) AS \"{s}\"" for s in ("Junior", "Middle", "Senior", "Lead")) + " FROM silver WHERE normalized_role IS NOT NULL AND seniority_level IS NOT NULL GROUP BY 1 HAVING avg(salary_max) IS NOT NULL"),
    "D4_drill_down": silver("SELECT job_id, title, work_mode FROM silver WHERE work_mode IN ('Remote', 'Hybrid')"),
    "N1_tokens": f"SELECT doc_id, array_to_string({TOKENS}, ' ') AS tokens FROM documents",
    "N2_ngram_counts": f"{GRAMS} SELECT gram, count FROM n ORDER BY count DESC, gram LIMIT 500",
    "N3_candidates": f"{GRAMS}, top AS (SELECT * FROM n ORDER BY count DESC, gram LIMIT 500) SELECT gram, count FROM top WHERE NOT regexp_matches(gram, '^\\d+$') AND len(gram) > 2 AND NOT (NOT contains(gram, ' ') AND len(gram) < 4 AND count < 5)",
    "N4_combined_text": postings("SELECT ord, coalesce(description, '') || ' ' || coalesce(requirements, '') AS text FROM postings"),
    "N4_null_counts": postings("SELECT count(*) AS rows, count(*) FILTER (WHERE salary IS NULL) AS null_salary, count(*) FILTER (WHERE requirements IS NULL) AS null_requirements, count(*) FILTER (WHERE deadline IS NULL) AS null_deadline FROM postings"),
    "C1_completeness": _checks("completeness", COMPLETE, COMPLETE_STATUS),
    "V1_validity": _checks("validity", VALID, VALID_STATUS),
    "A1_accuracy": _checks("accuracy", ACCURATE, ACCURATE_STATUS),
    "U1_duplicate_keys": "SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "U2_role_mismatch": silver(f"SELECT job_url, normalized_role, CASE WHEN normalized_role NOT IN ({', '.join(q(r) for r in V.ROLE_WORDS)}) THEN 'unknown_role' ELSE 'no_keyword_match' END AS reason FROM silver WHERE {MISMATCH}"),
    "U_uniqueness": silver(f", c AS (SELECT 'duplicate_job_url' AS \"check\", (SELECT count(*) FROM (SELECT 1 FROM silver WHERE job_url IS NOT NULL GROUP BY job_url HAVING count(*) > 1)) AS count, 2 AS lim UNION ALL SELECT 'role_title_consistency', (SELECT count(*) FROM silver WHERE {MISMATCH}), 5) SELECT 'uniqueness' AS stage, \"check\", count, (SELECT count(*) FROM silver) AS total, round(count * 100.0 / (SELECT count(*) FROM silver), 2) AS percentage, CASE WHEN count > lim THEN 'WARNING' ELSE 'OK' END AS status FROM c"),
    "T1_timeliness": "SELECT 'timeliness' AS stage, 'stale_records' AS \"check\", count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-31' - INTERVAL 30 DAYS) AS count, count(*) AS total, round(count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-31' - INTERVAL 30 DAYS) * 100.0 / count(*), 2) AS percentage, CASE WHEN count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-31' - INTERVAL 30 DAYS) * 100.0 / count(*) > 20 THEN 'WARNING' ELSE 'OK' END AS status FROM events",
    "R5_violation_sample": silver(
        ", v AS ("
        + " UNION ALL ".join(f"SELECT {q(n)} AS \"check\", job_url, exp_min, exp_max FROM silver WHERE {c}" for n, c in ACCURATE.items())
        + "), d AS (SELECT \"check\", job_url, '{\"exp_min\":' || coalesce(CAST(exp_min AS VARCHAR), 'null') || ',\"exp_max\":' || coalesce(CAST(exp_max AS VARCHAR), 'null') || '}' AS detail FROM v),"
        " r AS (SELECT *, CAST(row_number() OVER (PARTITION BY \"check\" ORDER BY job_url, detail) AS INTEGER) AS rank, greatest(count(*) OVER (PARTITION BY \"check\") - 10, 0) AS more FROM d) SELECT * FROM r WHERE rank <= 10"
    ),
}

def _stage_rows() -> str:
    """All results of completeness, validity and accuracy as one CTE list."""
    parts = []
    for stage, checks, status in (
        ("completeness", COMPLETE, COMPLETE_STATUS),
        ("validity", VALID, VALID_STATUS),
        ("accuracy", ACCURATE, ACCURATE_STATUS),
    ):
        rows = " UNION ALL ".join(f"SELECT {q(n)} AS \"check\", count(*) FILTER (WHERE {c}) AS count, count(*) AS total FROM silver" for n, c in checks.items())
        parts.append(f"SELECT {q(stage)} AS stage, {status} AS status FROM ({rows})")
    return ", results AS (" + " UNION ALL ".join(parts) + ")"


ORACLES["R3_gate"] = silver(_stage_rows() + " SELECT CAST(max(CASE WHEN status = 'ERROR' THEN 1 ELSE 0 END) AS INTEGER) AS exit_code FROM results")
ORACLES["R4_summary"] = silver(
    _stage_rows()
    + " SELECT stage, count(*) AS checks, count(*) FILTER (WHERE status = 'OK') AS ok, count(*) FILTER (WHERE status = 'WARNING') AS warning, count(*) FILTER (WHERE status = 'ERROR') AS error FROM results GROUP BY 1"
)

ORACLES |= {
    "R1_stage_selection": ORACLES["V1_validity"],
    **dict.fromkeys(["S1_read_records", "S1_read_arrays"], postings("SELECT title, company, location, salary, experience, url FROM postings")),
    "S2_read_silver": silver("SELECT job_id, normalized_role, salary_max, array_to_string(skills, ',') AS skills FROM silver"),
    "S3_read_by_suffix": silver("SELECT job_id, normalized_role, CASE WHEN len(skills) = 0 THEN '[]' ELSE '[\"' || array_to_string(skills, '\",\"') || '\"]' END AS skills FROM silver"),
    "S7_read_pages": "SELECT CAST(sum(length(regexp_replace(html, '\\s+', ' ', 'g'))) AS BIGINT) AS chars, true AS named FROM pages",
    "R2_stage_isolation": ORACLES["V1_validity"] + " UNION ALL SELECT 'broken', 'failed: AnalysisException', 0, 0, NULL, 'ERROR'",
    "S4_write_silver": silver("SELECT currency, count(*) AS n FROM silver GROUP BY 1"),
    "S5_write_gold": silver(f"SELECT normalized_role, {_mean('salary_max', 'salary_max_mean')} FROM silver WHERE normalized_role IS NOT NULL GROUP BY 1 HAVING avg(salary_min) IS NOT NULL AND avg(salary_max) IS NOT NULL"),
    "S6_append_landing": silver("SELECT CAST(substr(crawled_at, 1, 4) AS INTEGER) AS crawl_date, coalesce(normalized_role, 'other') AS role, 2 * count(*) AS n FROM parsed GROUP BY 1, 2"),
    "S8_read_gold": silver(", s AS (SELECT unnest(skills) AS k FROM silver) " + _counts("k", "item", 20, "s")),
    "S9_dataset_status": " UNION ALL ".join(f"SELECT '{t}' AS dataset, true AS present, count(*) AS rows FROM {t}" for t in ("documents", "pages", "orders")),
    "S10_write_report": silver(" UNION ALL ".join(f"SELECT * FROM (SELECT {q(n)} AS \"check\", count(*) AS n FROM silver WHERE {c}) WHERE n > 0" for n, c in ACCURATE.items())),
    "M10_stream_ingest": "SELECT page_id, normalized_url FROM (SELECT page_id, nullif(split_part(url, '?', 1), '') AS normalized_url, row_number() OVER (PARTITION BY split_part(url, '?', 1) ORDER BY page_id) AS n FROM pages) WHERE n = 1 AND normalized_url IS NOT NULL",
    "R2_run_time_isolation": ORACLES["V1_validity"] + " UNION ALL SELECT 'late', 'failed: ' || 'SparkRuntimeException', 0, 0, NULL, 'ERROR'",
    "S5_gold_rows": " UNION ALL ".join(
        f"SELECT {q(table)} AS name, count(*) AS n, round(sum(CAST({number} AS DOUBLE)), 3) AS sum FROM ({ORACLES[name]})"
        for table, name, number in [
            ("metrics", "G1_metrics", "total_jobs"), ("salary_by_role", "G2_salary_by_role", "salary_max_mean"),
            ("salary_by_seniority", "G3_salary_by_seniority", "salary_max_mean"), ("heatmap_salary", "G4_heatmap_salary", "salary_max_mean"),
            ("top_skills", "G5_top_skills", "count"), ("skills_by_role", "G6_skills_by_role", "count"),
            ("location_distribution", "G7_location_distribution", "count"),
            ("work_mode_distribution", "G8_work_mode_distribution", "count"), ("top_domains", "G9_top_domains", "count"),
        ]
    ),
}

_RESULTS = " UNION ALL ".join(f"SELECT * FROM ({ORACLES[n]})" for n in ("C1_completeness", "V1_validity", "A1_accuracy", "U_uniqueness"))
_RESULTS += " UNION ALL " + silver(
    "SELECT 'timeliness', 'stale_records', n, total, round(n * 100.0 / total, 2), CASE WHEN n * 100.0 / total > 20 THEN 'WARNING' ELSE 'OK' END FROM "
    "(SELECT count(*) FILTER (WHERE CAST(crawled_at AS TIMESTAMP) < TIMESTAMP '2000-01-01' - INTERVAL 30 DAYS) AS n, count(*) AS total FROM silver)"
).join(["SELECT * FROM (", ")"])
ORACLES["S10_report_results"] = (
    f"WITH results AS ({_RESULTS}) SELECT *, '2000-01-01T10:20:30' AS timestamp, 'silver' AS source, total AS total_records, "
    "CAST((SELECT max(CASE WHEN status = 'ERROR' THEN 1 ELSE 0 END) FROM results) AS BIGINT) AS exit_code, "
    "'completeness,validity,accuracy,uniqueness,timeliness' AS stages FROM results"
)
ORACLES["S10_report_markdown"] = f"SELECT stage, \"check\", count FROM ({_RESULTS})"
ORACLES["G_kept_up_to_date"] = " UNION ALL ".join(
    f"SELECT {q(table)} AS name, {keys} AS keys, round(CAST({number} AS DOUBLE), 6) AS number, round(CAST({more} AS DOUBLE), 6) AS more FROM ({ORACLES[name]})"
    for table, name, keys, number, more in [
        ("metrics", "G1_metrics", "top_role || '|' || top_location", "total_jobs", "avg_salary_max"),
        ("salary_by_role", "G2_salary_by_role", "normalized_role", "salary_min_mean", "salary_max_mean"),
        ("salary_by_seniority", "G3_salary_by_seniority", "seniority_level", "salary_max_mean", "NULL"),
        ("heatmap_salary", "G4_heatmap_salary", "normalized_role || '|' || seniority_level", "salary_max_mean", "NULL"),
        ("top_skills", "G5_top_skills", "skill", "count", "NULL"),
        ("skills_by_role", "G6_skills_by_role", "normalized_role || '|' || skills", "count", "NULL"),
        ("location_distribution", "G7_location_distribution", "location", "count", "NULL"),
        ("work_mode_distribution", "G8_work_mode_distribution", "work_mode", "count", "NULL"),
        ("top_domains", "G9_top_domains", "domain", "count", "NULL"),
    ]
)
ORACLES["M9_pending_by_bitmap"] = (
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')"
)
ORACLES["S6_land_once"] = silver(
    "SELECT run, substr(crawled_at, 1, 4) AS crawl_date, normalized_role AS role, job_id AS id, title, job_url AS url FROM parsed, (SELECT unnest(['first', 'second']) AS run)"
)
