"""Case tables of the normalisers: input and expected value side by side."""

import pytest
from pyspark.sql import functions as F

from vacancy_lake.functions import normalise as N
from vacancy_lake.functions import text as X


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (None, (None, None, None, False)),
        ("", (None, None, None, False)),
        ("Thoả thuận", (None, None, None, True)),
        ("THƯƠNG LƯỢNG", (None, None, None, True)),
        ("10 - 25 triệu", (10.0, 25.0, "VND", False)),
        ("Tới 26.5 triệu", (None, 26.5, "VND", False)),
        ("10,000,000 - 20,000,000 VND", (10.0, 20.0, "VND", False)),
        ("800 - 3,100 USD", (800.0, 3100.0, "USD", False)),
        ("1.500.000", (0.0, 1.5, "VND", False)),
        ("Cạnh tranh", (None, None, None, True)),
        ("20 - 30 triệu + tháng 13", (13.0, 30.0, "VND", False)),
    ],
)
def test_salary(spark, raw, expected):
    got = one(spark, N.parse_salary(F.col("raw")), raw=raw)
    assert tuple(got)[:4] == expected


def test_salary_of_a_lone_comma_is_rejected(spark):
    assert one(spark, N.parse_salary(F.col("raw")), raw="Lương, thưởng").bad_number


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (None, (None, None)), ("", (None, None)), ("3 năm", (3, 3)), ("Trên 5 năm", (5, None)), ("Dưới 1 năm", (0, 1)),
        ("Không yêu cầu", (0, None)), ("2 - 5 năm", (2, 5)), ("5+ năm", (5, None)), ("Fresher", (0, 0)),
        ("tuỳ vị trí", (None, None)), ("2-3", (2, 3)), ("7", (7, 7)), ("1.5 năm", (1, 1)), ("3 năm trở lên", (3, None)),
    ],
)
def test_experience(spark, raw, expected):
    assert tuple(one(spark, N.parse_experience(F.col("raw")), raw=raw)) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (None, None), ("", None), ("Hà Nội", "Hà Nội"), ("Hồ Chí Minh (mới)", "Hồ Chí Minh"),
        ("Việc làm tại Đà Nẵng", "Đà Nẵng"), ("Hải Phòng, Hà Nội", "Hải Phòng"), ("Tokyo", "Tokyo"),
        ("Bà Rịa - Vũng Tàu", "Bà Rịa"), ("(mới)", ""), ("Saigon | Hanoi", "Hồ Chí Minh"), ("tp.hcm", "Hồ Chí Minh"),
    ],
)
def test_location(spark, raw, expected):
    assert one(spark, N.clean_location(F.col("raw")), raw=raw) == expected


@pytest.mark.parametrize(
    ("title", "expected"),
    [
        ("Senior Data Engineer", "Data Engineer"), ("BI Analyst", "BI Analyst"), ("Database Engineer", None),
        ("Data Architect", None), ("Data Solution Architect", "Data Architect"), ("DBA", "Database Engineer"),
        ("Kế toán", None), (None, None), ("", None), ("Data & Reporting lead", "Data Manager"),
    ],
)
def test_role(spark, title, expected):
    assert one(spark, N.normalize_role(F.col("title")), title=title) == expected


@pytest.mark.parametrize(
    ("title", "years", "expected"),
    [("Senior X", 1, "Senior"), ("X", 0, "Junior"), ("X", 3, "Middle"), ("X", 6, "Senior"), ("X", 9, "Lead"), ("Leader", 200, "Unknown")],
)
def test_seniority(spark, title, years, expected):
    assert one(spark, N.derive_seniority(F.col("title"), F.col("years")), title=title, years=years) == expected


def test_keywords_meet_letters_outside_ascii(spark):
    words = X.keywords_in(F.lower("t"), ["r", "c++", "power bi", "python"])
    assert one(spark, words, t="Rõ ràng; Power  BI, C++ pythonic") == ["c++", "power bi", "r"]


def test_phrases_take_whole_unicode_words(spark):
    assert one(spark, X.phrases_in(F.lower("t"), ["ai", "r"]), t="AI rõ") == ["ai"]


def test_blank_and_null_texts(spark):
    assert one(spark, X.keywords_in(F.col("t"), ["r"]), t="") == []
    assert one(spark, X.is_blank(F.col("t")), t="   ") is True
    assert one(spark, N.parse_list(F.col("t")), t="x") == []
    assert one(spark, N.deadline_to_iso(F.col("t")), t="hạn 31-12-2026") == "2026-12-31"


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("Up to 3,000 USD", (None, 3000.0, "USD", None)),
        ("1,000 - 2,000 USD / month", (1000.0, 2000.0, "USD", "MONTH")),
        ("20000000 VND một năm", (20.0, 20.0, "VND", "YEAR")),
        ("", (None, None, None, None)),
    ],
)
def test_salary_with_unit(spark, raw, expected):
    assert tuple(one(spark, N.parse_salary_with_unit(F.col("raw")), raw=raw))[:4] == expected
