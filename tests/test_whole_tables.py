"""Queries without SQL that return every page, against plain versions on the smallest tables."""

import html
import re

from vacancy_lake.plans.queries import QUERIES, job_pages

SF = "/root/testdata/sf0.001"


def text_of(page):
    for tag in ("head", "script", "style", "nav", "footer", "header"):
        page = re.sub(rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ", page)
    return " ".join(html.unescape(re.sub(r"(?s)<[^>]*>", " ", page)).split())


def test_all_salaries_and_descriptions(spark):
    pages = {r.ord: r.html for r in job_pages(spark, SF).collect()}
    found = QUERIES["H6_html_salary_all"](spark, SF).collect()
    assert len(found) == len(pages) and {r.ord for r in found} == set(pages)
    for r in found:
        label = re.search(r"<strong>Salary</strong> (\d+) - (\d+) USD", pages[r.ord])
        money = re.search(
            r"(?i)(?:\$|usd)\s*(\d{2,6})\s*[-–—]\s*(\d{2,6})|(\d{2,6})\s*[-–—]\s*(\d{2,6})\s*(?:usd|\$|triệu|vnd|₫)",
            text_of(pages[r.ord]),
        )
        if label:
            want = (float(label[1]), float(label[2]), "html-label")
        elif money:
            low, high = [float(x) for x in money.groups() if x]
            want = (low, high, "html-pattern")
        else:
            want = (None, None, None)
        assert (r.salary_min, r.salary_max, r.salary_source) == want, (r, text_of(pages[r.ord]))
    assert any(r.ord % 4 == 0 and r.salary_source for r in found)
    described = {r.ord: r.description for r in QUERIES["H9_brand_description_all"](spark, SF).collect()}
    assert set(described) == set(pages)
    for k, page in pages.items():
        section = re.search(r"<h2>Mô tả công việc</h2>(.*?)<h2>", page, re.S)[1]
        section, page = text_of(section), text_of(page)
        at = page.lower().find("yêu cầu ứng viên")
        tail = page[max(0, at - 3000) : at].strip()
        want = section if len(section) > 50 else tail if at > 200 and len(tail) > 100 else ""
        assert described[k] == want, k
    assert len({len(x) > 50 for x in described.values()}) == 2


def test_every_page_is_on_a_side(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    keys = {r.page_id: (r.url or "").split("?")[0] or None for r in rows}
    old = [i for i in keys if i % 3]
    new = [i for i in keys if i % 2 == 0 or i % 3 == 0]
    assert set(old) | set(new) == set(keys)

    def without(ids, others):
        seen = {keys[i] for i in others}
        return [i for i in ids if keys[i] is None or keys[i] not in seen]

    def first_of_new_keys(ids, others):
        seen = {keys[i] for i in others} | {None}
        return [i for i in sorted(ids) if not (keys[i] in seen or seen.add(keys[i]))]

    def ids(name):
        return sorted(r.page_id for r in QUERIES[name](spark, SF).collect())

    added = first_of_new_keys(new, old)
    assert ids("M7_insert_only_all") == sorted(old + added)
    assert tuple(QUERIES["M7_insert_counts_all"](spark, SF).first()) == (len(old) + len(added), len(added))
    pending = without(old, new)
    assert ids("M9_pending_all") == sorted(pending)
    marked = {keys[i] for i in keys if i % 5 == 0} - {None}
    assert ids("M10_resume_all") == sorted(i for i in pending if keys[i] in marked)
