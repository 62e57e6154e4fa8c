"""Normalisers of posting fields, one column expression each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocabulary as V
from .text import NO_WORD_AFTER, NO_WORD_BEFORE, collapse_spaces, first_contained, first_match, given, join_given, keywords_in, let, phrases_in, strip

#: A prefix of locations, and separators in the order in which they are tried.
LOCATION_PREFIX = "Việc làm tại "
SEPARATORS = [" & ", " | ", " / ", ", ", " - "]


def location_part(raw: Column) -> Column:
    """The first place of a location text, without brackets; null for null or empty."""

    def first_part(text: Column) -> Column:
        text = F.when(text.startswith(LOCATION_PREFIX), F.replace(text, F.lit(LOCATION_PREFIX), F.lit(""))).otherwise(text)
        # The mark that comes first in the list, not in the text, cuts.
        mark = F.coalesce(*[F.when(F.contains(text, F.lit(m)), F.lit(m)) for m in SEPARATORS])
        part = F.when(mark.isNull(), text).otherwise(strip(F.split_part(text, mark, F.lit(1))))
        # Few places have brackets, and a search through the text costs less than the pattern.
        return let(part, lambda p: strip(F.when(p.contains("("), F.regexp_replace(p, r"(?U)\s*\([^)]*\)\s*", " ")).otherwise(p)))

    return F.when(given(raw), let(strip(raw), first_part))


def city_of(part: Column, cities: dict[str, list[str]] | None = None) -> Column:
    """The first city one of whose names a place holds, else the place itself."""
    rules = [(F.lit(city), names) for city, names in (cities or V.CITIES).items()]

    def first_city(place: Column, low: Column) -> Column:
        # Names are tried in order, city by city.
        found = [F.when(reduce(Column.__or__, [low.contains(n) for n in names]), city) for city, names in rules if names]
        return F.coalesce(*found, place)

    return let(part, lambda place: let(F.lower(place), lambda low: first_city(place, low)))


def clean_location(raw: Column, cities: dict[str, list[str]] | None = None) -> Column:
    """City of a location text, else the text's first part; null for null or empty."""
    return city_of(location_part(raw), cities)


def parse_experience(raw: Column) -> Column:
    """struct(exp_min, exp_max) in whole years."""
    number = r"(\d+(?:\.\d+)?)"
    none = F.lit(None).cast("int")
    over, under = rf"(?U)trên\s*{number}\s*năm", rf"(?U)dưới\s*{number}\s*năm"
    units, plain = rf"(?U){number}\s*[-–—]\s*{number}\s*(?:năm|year|yr)", r"(?U)(\d+)\s*[-–—]\s*(\d+)"
    one, only = rf"(?U){number}\s*(?:\+|trở lên|năm|year|yr)", rf"(?U)^{number}$"

    def pair(low: Column, high: Column) -> Column:
        return F.struct(low.alias("exp_min"), high.alias("exp_max"))

    def parsed(text: Column) -> Column:
        def years(pattern: str, group: int = 1) -> Column:
            return F.regexp_extract(text, pattern, group).try_cast("double").cast("int")

        def any_of(*literals: str) -> Column:
            return reduce(Column.__or__, [text.contains(v) for v in literals])

        # A pattern runs only on texts that hold what it needs.
        open_ended, span = any_of("+", "trở lên"), any_of("-", "–", "—")
        return (
            F.when(any_of("không", "none", "no experience"), pair(F.lit(0), none))
            .when(any_of("trên") & text.rlike(over), pair(years(over), none))
            .when(any_of("dưới") & text.rlike(under), pair(F.lit(0), years(under)))
            .when(span & text.rlike(units), pair(years(units), years(units, 2)))
            .when(span & text.rlike(plain), pair(years(plain), years(plain, 2)))
            .when(text.rlike(one), let(years(one), lambda n: pair(n, F.when(~open_ended, n))))
            .when(text.rlike(only), let(years(only), lambda n: pair(n, n)))
            .when(any_of("fresher", "intern", "mới ra trường"), pair(F.lit(0), F.lit(0)))
            .otherwise(pair(none, none))
        )

    return F.when(given(raw), let(F.lower(strip(raw)), parsed)).otherwise(pair(none, none))


def _scaled(value: Column, currency: Column) -> Column:
    """Dong above 1000 become millions; one decimal."""
    return F.round(F.when((currency == "VND") & (value > 1000), value / 1_000_000).otherwise(value), 1)


def parse_salary(raw: Column) -> Column:
    """struct(salary_min, salary_max, currency, is_negotiable, bad_number).

    ``bad_number`` is true where a number token holds no digit (a comma on its own): such a record
    is rejected as a whole.
    """
    none, no = F.lit(None).cast("double"), F.lit(False)
    until = r"(?iuU)tới\s*([\d,]+)\s*(?:triệu|m|milion)?"

    def made(low: Column, high: Column, unit: Column, negotiable: Column, wrong: Column = no) -> Column:
        return F.struct(
            low.alias("salary_min"),
            high.alias("salary_max"),
            unit.alias("currency"),
            negotiable.alias("is_negotiable"),
            wrong.alias("bad_number"),
        )

    unit = F.lit(None).cast("string")

    def number_of(token: Column) -> Column:
        return F.replace(token, F.lit(","), F.lit("")).try_cast("double")

    def numbers_in(text: Column) -> Column:
        plain = F.regexp_replace(text, r"(?iu)thưởng|bonus|upto|up to|~|khoảng|tr\.|triệu|đồng|\$", "")
        plain = F.regexp_replace(plain, r"[^0-9,.\-–—]", " ")
        return F.transform(F.regexp_extract_all(plain, F.lit(r"([\d,]+\.?\d*)"), F.lit(1)), number_of)

    def parsed(text: Column) -> Column:
        currency = F.when(F.lower(text).contains("usd"), "USD").otherwise("VND")

        def of_numbers(numbers: Column) -> Column:
            return (
                F.when(
                    (F.size(numbers) == 0) & text.rlike(until),
                    made(none, _scaled(number_of(F.regexp_extract(text, until, 1)), currency), currency, no),
                )
                .when(F.size(numbers) == 0, made(none, none, unit, F.lit(True)))
                .when(F.exists(numbers, lambda v: v.isNull()), made(none, none, unit, no, F.lit(True)))
                .otherwise(
                    made(
                        F.when(F.size(numbers) > 1, _scaled(F.array_min(numbers), currency)),
                        _scaled(F.array_max(numbers), currency),
                        currency,
                        no,
                    )
                )
            )

        open_to_talk = text.rlike("(?iu)thoả thuận|thương lượng|negotiable|négociable")
        return F.when(open_to_talk, made(none, none, unit, F.lit(True))).otherwise(let(numbers_in(text), of_numbers))

    return F.when(given(raw), let(strip(raw), parsed)).otherwise(made(none, none, unit, no))


def extract_skills(
    title: Column,
    description: Column,
    requirements: Column,
    vocabulary: list[str] = V.SKILLS,
    domains: list[str] = V.DOMAINS,
) -> Column:
    """Skills named in the texts, those that are domain keywords left out."""
    return keywords_in(join_given(title, description, requirements), [w for w in vocabulary if w not in set(domains)])


def extract_domains(
    title: Column, description: Column, requirements: Column, vocabulary: list[str] = V.DOMAINS
) -> Column:
    """Domain keywords named in the texts."""
    return phrases_in(join_given(title, description, requirements), vocabulary)


def normalize_role(title: Column, rules: list[tuple[str, str]] = V.ROLES) -> Column:
    """First role whose pattern the title holds; null if none."""
    return F.when(given(title), let(F.lower(title), lambda low: first_match(low, rules)))


def derive_seniority(title: Column, exp_min: Column) -> Column:
    """By the title, else by years; Unknown if neither tells; null without title and years."""
    by_years = F.coalesce(*[F.when(exp_min.between(low, high), F.lit(name)) for low, high, name in V.YEARS])
    by_title = F.when(given(title), let(F.lower(title), lambda low: first_match(low, V.SENIORITY)))
    return F.when(given(title) | exp_min.isNotNull(), F.coalesce(by_title, by_years, F.lit("Unknown")))


def derive_work_mode(working_time: Column, description: Column, requirements: Column) -> Column:
    """struct(work_mode, job_work_from_home); Onsite by default."""

    def mode(name: str, home: bool) -> Column:
        return F.struct(F.lit(name).alias("work_mode"), F.lit(home).alias("job_work_from_home"))

    rules = [(k, mode(name, home)) for k, name, home in V.WORK_MODES]
    found = let(join_given(working_time, description, requirements), lambda text: first_contained(text, rules))
    return F.coalesce(found, mode("Onsite", False))


def schedule_type(job_type: Column) -> Column:
    """Schedule by exact name, else null."""
    return F.coalesce(*[F.when(job_type == k, F.lit(v)) for k, v in V.SCHEDULES.items()])


def parse_list(text: Column) -> Column:
    """A list written as text, in single or double quotes; anything else is an empty list."""
    empty = F.array().cast("array<string>")
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
    return F.when(text.startswith("["), F.coalesce(parsed, empty)).otherwise(empty)


def split_list(text: Column) -> Column:
    """Comma-separated items, trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(text, ","), strip), lambda x: x != "")


def iso_to_timestamp(text: Column) -> Column:
    """ISO 8601 text as a timestamp, null if it is none."""
    return F.try_to_timestamp(text)


def timestamp_to_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def deadline_to_iso(text: Column) -> Column:
    """dd/mm/yyyy or dd-mm-yyyy anywhere in the text as yyyy-mm-dd (digits only, no calendar)."""
    pattern = r"(\d{2})[/-](\d{2})[/-](\d{4})"
    day, month, year = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
    iso = F.concat_ws("-", year, month, day)
    return F.when(text.rlike(pattern), iso)


def first_integer(text: Column) -> Column:
    return F.regexp_extract(text, r"\d+", 0).try_cast("int")


def deadline_or_page(text: Column, page_text: Column) -> Column:
    """The deadline field's date; where it is given without one, the page's "Hạn nộp hồ sơ"."""
    in_page = F.regexp_extract(page_text, r"(?U)Hạn nộp hồ sơ:\s*(\d{2}/\d{2}/\d{4})", 1)
    return F.when(given(text), F.coalesce(deadline_to_iso(text), deadline_to_iso(in_page)))


def fill_city(location: Column, detail: Column) -> Column:
    """City named in the detailed location where the location is blank or a placeholder."""
    cities = "Hà Nội|Hồ Chí Minh|Đà Nẵng|Hải Phòng|Cần Thơ"
    found = F.nullif(F.regexp_extract(detail, cities, 0), F.lit(""))
    missing = location.isNull() | (F.trim(location) == "") | (location == "Địa điểm")
    return F.when(missing, F.coalesce(found, location)).otherwise(location)


def blank_salary_noise(text: Column) -> Column:
    """Salaries that only compare with the market are no salaries."""
    return F.when(text.contains("thị trường cho vị trí này"), F.lit("")).otherwise(text)


def parse_salary_with_unit(raw: Column) -> Column:
    """struct(salary_min, salary_max, currency, unit, is_negotiable) of texts such as
    "Up to 3,000 USD / year": the first two numbers count; one alone is both bounds, or the upper."""
    text = F.replace(raw, F.lit(","), F.lit(""))
    low = F.lower(text)
    currency = F.when(low.rlike(r"usd|\$"), "USD").when(low.rlike("vnd|₫|đồng|triệu"), "VND")
    unit = (
        F.when(low.rlike("tháng|month"), "MONTH").when(low.rlike("năm|year"), "YEAR").when(low.rlike("giờ|hour"), "HOUR")
    )
    numbers = F.transform(
        F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)), lambda t: t.cast("double")
    )
    two = F.slice(numbers, 1, 2)
    upper_only = (F.size(numbers) == 1) & low.rlike("up to|tối đa|max")
    some = F.coalesce(F.size(numbers) > 0, F.lit(False))
    none = low.rlike("thoả thuận|negotiable|competitive")
    return F.struct(
        F.when(some & ~upper_only, _scaled(F.array_min(two), currency)).alias("salary_min"),
        F.when(some, _scaled(F.array_max(two), currency)).alias("salary_max"),
        currency.alias("currency"),
        unit.alias("unit"),
        F.coalesce(~some & none, F.lit(False)).alias("is_negotiable"),
    )


#: What is never a salary, and signs of a currency.
NOT_SALARY = [
    "it salary report", "salary report", "salary survey", "›", "breadcrumblist",
    "sign in to view", "you.ll love it", "you'll love",
]
CURRENCY_SIGN = r"usd|\$|vnd|₫|triệu|million"


def is_salary_text(text: Column, low: Column, high: Column) -> Column:
    """True if a text with these bounds can be a salary, not an advertisement, a path or a date."""
    lower = F.lower(text)
    sign = lower.rlike(CURRENCY_SIGN)

    def year(v: Column) -> Column:
        return F.coalesce(v.between(2015, 2035), F.lit(False))

    both = F.coalesce((low >= 2020) & (high <= 2030) & (high - low <= 5), F.lit(False))
    wider = F.coalesce(high > low, F.lit(False))
    month = NO_WORD_BEFORE + r"20\d{2}\s*[-–—]\s*(0?[1-9]|1[0-2])" + NO_WORD_AFTER
    wrong = lower.rlike("|".join(NOT_SALARY)) | lower.rlike(month) | both | ((year(low) != year(high)) & ~sign)
    return F.coalesce(given(text) & lower.rlike(r"\d") & ~wrong & (sign | wider), F.lit(False))


def source_job_id(source: str, slug: Column) -> Column:
    return F.concat(F.lit(source + "_"), slug)


def job_url_or_slug(url: Column, slug: Column, base: str) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit(base), slug))


def salary_hidden(text: Column) -> Column:
    """True if blank, or if one has to sign in to see it."""
    return F.coalesce((collapse_spaces(text) == "") | text.rlike("(?i)sign in"), F.lit(True))
