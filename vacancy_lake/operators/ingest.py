"""Keys, merges, deduplication and upserts of posting records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import given, is_blank


def normalize_url(url: Column) -> Column:
    """The URL up to its query; null for null or empty."""
    return F.nullif(F.substring_index(url, "?", 1), F.lit(""))


def id_from_url(url: Column, prefixed: bool = False) -> Column:
    """The number before ``.html``; ``prefixed``: also after a hyphen and the letter j."""
    plain = F.nullif(F.regexp_extract(url, r"/(\d+)\.html", 1), F.lit(""))
    if not prefixed:
        return plain
    first = F.nullif(F.regexp_extract(url, r"[-/](?:j?)(\d+)\.html", 1), F.lit(""))
    return F.coalesce(first, F.nullif(F.regexp_extract(url, r"(\d+)\.html", 1), F.lit("")))


def id_or_from_url(given_id: Column, url: Column) -> Column:
    return F.coalesce(F.nullif(given_id, F.lit("")), id_from_url(url))


def merge_keys(listed: DataFrame, detail: DataFrame, text: DataFrame) -> DataFrame:
    """Distinct non-empty keys of the three sources."""
    keys = listed.select(normalize_url(F.col("url")).alias("normalized_url"))
    for other in (detail, text):
        keys = keys.unionByName(other.select("normalized_url"))
    return keys.filter(given(F.col("normalized_url"))).distinct()


#: What the text source may add to a record.
TEXT_FIELDS = ["description", "requirements", "benefits", "crawled_at"]


def merge_sources(listed: DataFrame, detail: DataFrame, text: DataFrame, order: str = "ord") -> DataFrame:
    """One row per key; each field is the first non-blank value by source (list, detail, text), then ``order``.

    One shuffle on the key and no join: the sources are stacked with their priority and aggregated,
    and each field's first value combines before the shuffle.
    """

    def tagged(df: DataFrame, priority: int, key: Column, fields: Sequence[str]) -> DataFrame:
        return df.select(key.alias("normalized_url"), F.struct(F.lit(priority).alias("p"), F.col(order).alias("o")).alias("__at"), *fields)

    skip = {"normalized_url", "url", order}
    of_list = [c for c in listed.columns if c not in skip]
    of_detail = [c for c in detail.columns if c not in skip]
    of_text = [c for c in TEXT_FIELDS if c in text.columns]
    stacked = tagged(listed, 0, normalize_url(F.col("url")), of_list)
    for priority, (df, fields) in enumerate([(detail, of_detail), (text, of_text)], 1):
        stacked = stacked.unionByName(tagged(df, priority, F.col("normalized_url"), fields), allowMissingColumns=True)
    fields = [c for c in stacked.columns if c not in ("normalized_url", "__at")]

    def usable(c: str) -> Column:
        return ~is_blank(F.col(c)) if dict(stacked.dtypes)[c] == "string" else F.col(c).isNotNull()

    firsts = [F.min_by(F.when(usable(c), F.col(c)), F.when(usable(c), F.col("__at"))).alias(c) for c in fields]
    merged = stacked.filter(given(F.col("normalized_url"))).groupBy("normalized_url").agg(*firsts)
    return merged.withColumn("url", F.col("normalized_url"))


def fill_defaults(merged: DataFrame, source: str = "TopCV") -> DataFrame:
    """Id from the URL, the source's name, and a title where it is blank."""
    out = merged if "id" in merged.columns else merged.withColumn("id", F.lit(None).cast("string"))
    out = out if "source" in out.columns else out.withColumn("source", F.lit(None).cast("string"))
    out = out.withColumn("id", id_or_from_url(F.col("id"), F.col("normalized_url")))
    named = F.concat(F.lit("Job "), F.coalesce("id", F.lit("unknown")))
    return out.withColumns(
        {
            "source": F.coalesce("source", F.lit(source)),
            "title": F.when(is_blank(F.col("title")), named).otherwise(F.col("title")),
        }
    )


def keep_first(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; rows with a null key go."""
    keyed = df.withColumn("__key", key).filter(F.col("__key").isNotNull())
    first = F.row_number().over(Window.partitionBy("__key").orderBy(*order))
    return keyed.withColumn("__n", first).filter("__n = 1").drop("__n", "__key")


def has_key(key: str) -> Column:
    return F.col(key).isNotNull() & (F.col(key).cast("string") != "")


def insert_only(existing: DataFrame, new: DataFrame, key: str, order: Sequence[str] | None = None) -> DataFrame:
    """Existing rows as they are, and of each key that they lack the first new row by ``order`` (None:
    by all columns).  New rows with a null or empty key are left out."""
    added = new.filter(has_key(key)).join(existing.select(key), key, "left_anti")
    added = keep_first(added, F.col(key), order or [c for c in new.columns if c != key] or [key])
    return existing.unionByName(added, allowMissingColumns=True)


def insert_counts(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """total, added of insert_only: one row."""
    keys = new.filter(has_key(key)).select(key).distinct()
    added = keys.join(existing.select(key), key, "left_anti").select(F.lit(1).alias("added"))
    marks = existing.select(F.lit(0).alias("added")).unionByName(added)
    return marks.agg(F.count("*").alias("total"), F.coalesce(F.sum("added"), F.lit(0)).alias("added"))


def overlay(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old ones field by field, nulls too; fields that only old has stay."""
    mark = new.withColumn("__new", F.lit(True)).alias("n")
    joined = old.alias("o").join(mark, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    is_new = F.col("n.__new").isNotNull()
    columns = [F.coalesce(f"n.{key}", f"o.{key}").alias(key)]
    for c in [*old.columns, *[c for c in new.columns if c not in old.columns]]:
        if c == key:
            continue
        if c not in new.columns:
            columns.append(F.col(f"o.{c}").alias(c))
        elif c not in old.columns:
            columns.append(F.col(f"n.{c}").alias(c))
        else:
            columns.append(F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return joined.select(*columns)


def pending(listed: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Listed rows that are not done yet."""
    return listed.join(done.select(key), key, "left_anti")


#: Bits of a bitmap row, as Spark's bitmap functions have them.
BITMAP_BITS = 32_768
#: A larger bitmap is not broadcast (two bytes a done key at 16 bits: 64 MB for 33 million keys).
BITMAP_BYTES = 64 << 20


def maybe_done(listed: DataFrame, done: DataFrame, key: str, bits: int) -> DataFrame:
    """``listed`` with ``__maybe``: false where a bitmap of ``bits`` hashed done keys denies the row's key."""

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits))

    where = place(F.col(key))
    marks = done.select(F.col(key)).filter(F.col(key).isNotNull())
    bitmap = marks.groupBy(F.floor(where / BITMAP_BITS).alias("__row")).agg(
        F.bitmap_construct_agg((where % BITMAP_BITS)).alias("__bits")
    )
    rows = listed.withColumn("__place", where).withColumn("__row", F.floor(F.col("__place") / BITMAP_BITS))
    at = (F.col("__place") % BITMAP_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.col(key).isNotNull() & (F.getbit(byte, at % 8) == 1)
    return rows.join(F.broadcast(bitmap), "__row", "left").select(*listed.columns, F.coalesce(held, F.lit(False)).alias("__maybe"))


def pending_by_bitmap(listed: DataFrame, done: DataFrame, key: str, bits_per_key: int = 16, most_bytes: int = BITMAP_BYTES) -> DataFrame:
    """The rows of ``pending`` for a large done set: rows whose key the bitmap of done keys denies are pending
    at once, and only the others (all done ones, and one of ``bits_per_key`` of the rest) go to the exact join.

    The done keys are counted first; a bitmap of over ``most_bytes`` is not built, and the exact join does it all.
    A null key is pending; repeated rows stay.  Listed rows are read twice, done keys twice; what is saved is the
    shuffle of pending rows.
    """
    order = [key, *[c for c in listed.columns if c != key]]
    bits = -(-max(done.count(), 1) * bits_per_key // BITMAP_BITS) * BITMAP_BITS
    if bits // 8 > most_bytes:
        return pending(listed, done, key).select(*order)
    rows = maybe_done(listed, done, key, bits)
    rest = pending(rows.filter("__maybe"), done, key)
    return rows.filter("NOT __maybe").select(*order).unionByName(rest.select(*order))


def resume(listed: DataFrame, done: DataFrame, checkpoint: DataFrame, key: str) -> DataFrame:
    """Pending rows of a checkpoint."""
    return pending(listed, done, key).join(checkpoint.select(key), key, "left_semi")


def repair_titles(detail: DataFrame, listed: DataFrame, key: str = "normalized_url") -> DataFrame:
    """Placeholder titles replaced by the listing's; ``original_title`` keeps what was there."""
    titles = listed.select(key, F.col("title").alias("__listed")).filter(given(F.col("__listed")))
    titles = titles.groupBy(key).agg(F.min("__listed").alias("__listed"))
    bad = F.coalesce(F.col("title").isin("Tin tuyển dụng", ""), F.lit(True)) | F.coalesce(
        (F.col("title") == F.col("company")) | F.col("title").contains("topcv.vn"), F.lit(False)
    )
    joined = detail.drop("original_title").join(titles, key, "left")
    return joined.withColumns(
        {"original_title": F.col("title"), "title": F.when(bad, F.coalesce("__listed", "title")).otherwise(F.col("title"))}
    ).drop("__listed")


def overlay_matched(listed: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Listed rows that have a detail, overlaid by it; ``salary_hidden`` if no bound is known."""
    extra = [c for c in listed.columns if c not in detail.columns]
    joined = detail.join(listed.select(key, *[c for c in extra if c != key]), key)
    hidden = F.col("salary_min").isNull() & F.col("salary_max").isNull()
    return joined.withColumn("salary_hidden", hidden)


def run_summary(runs: DataFrame, by: str, added: Column, found: Column, error: Column | None = None) -> DataFrame:
    """found, added, total, share of found, status and error per group.

    A group is ``failed`` if any of its rows has an ``error``, and shows the smallest; else ``success``.
    """
    wrong = F.min(F.lit(None).cast("string") if error is None else error)
    return runs.groupBy(by).agg(
        F.count_if(found).alias("found"),
        F.count_if(added).alias("added"),
        F.count("*").alias("total"),
        (F.count_if(found) / F.count("*")).alias("found_share"),
        F.when(wrong.isNull(), "success").otherwise("failed").alias("status"),
        wrong.alias("error"),
    )


def run_exit_code(summary: DataFrame) -> DataFrame:
    """succeeded, failed (groups) and exit_code (1 if any failed): one row."""
    failed = F.count_if(F.col("status") == "failed")
    return summary.agg(
        F.count_if(F.col("status") == "success").alias("succeeded"),
        failed.alias("failed"),
        F.when(failed > 0, 1).otherwise(0).alias("exit_code"),
    )


def keyword_titles(df: DataFrame, word: str = "data", column: str = "title") -> DataFrame:
    """Rows whose title holds the word in any case."""
    return df.filter(given(F.col(column)) & F.lower(column).contains(word))


#: Marks of challenge pages in the head, and of error pages in the title.
CHALLENGES = ["just a moment", "cf-challenge", "challenge-platform", 'id="challenge-form"', 'id="cf-wrapper"']
ERRORS = ["403", "404", "not found", "forbidden", "access denied"]


def valid_page(html: Column, status: Column | None = None, final_url: Column | None = None, url: Column | None = None) -> Column:
    """True for a page that was really delivered: status 200, no redirect, no challenge, no error title."""
    head = F.lower(F.regexp_extract(html, r"(?is)<head.*?</head>", 0))
    title = F.regexp_extract(head, r"(?s)<title[^>]*>(.*?)</title>", 1)
    ok = html.isNotNull()
    for mark in CHALLENGES:
        ok &= ~head.contains(mark)
    for mark in ERRORS:
        ok &= ~title.contains(mark)
    if status is not None:
        ok &= status.isNull() | (status == 200)
    if final_url is not None and url is not None:
        ok &= normalize_url(final_url).eqNullSafe(normalize_url(url))
    return F.coalesce(ok, F.lit(False))


#: Names of the second source's columns.
SECOND_SOURCE = {"job_id": "id", "job_url": "url", "job_title": "title", "company_name": "company", "work_model": "work_mode"}


def union_listings(first: DataFrame, second: DataFrame, names: dict[str, str] = SECOND_SOURCE) -> DataFrame:
    """Listings of two sources under one set of names; what one lacks is null."""
    renamed = second.withColumnsRenamed(names)
    return first.unionByName(renamed, allowMissingColumns=True)
