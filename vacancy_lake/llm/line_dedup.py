"""Cross-site boilerplate lines, by the number of distinct sites a line occurs on.

DataFrame functions only.  One aggregation builds a HyperLogLog sketch of the sites of each line
(partial sketches merge before and after the shuffle, so a line in a third of all documents costs
one sketch per task).  Lines whose estimate is far from the threshold are decided by it; those near
it get an exact distinct count.  Then boilerplate lines leave every document but the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written


def line_key(line: Column) -> Column:
    """64 bits stand for a line.  Only a line whose key equals that of a boilerplate line could be
    hit by mistake: for 10^6 boilerplate lines among 10^12 the odds of any such case are 1 in 18."""
    return F.xxhash64(line)


def has_word(line: Column) -> Column:
    """True for a line with anything but white space."""
    return line.rlike(r"[^\x20\x09-\x0D]")


def lines_of(docs: DataFrame) -> DataFrame:
    """Distinct lines with a word of each document: __id, __site, key."""
    line = F.explode(F.array_distinct(F.split("__text", "\n", -1))).alias("line")
    return docs.select("__id", "__site", line).filter(has_word(F.col("line"))).select(
        "__id", "__site", line_key(F.col("line")).alias("key")
    )


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int, band: float) -> DataFrame:
    """Keys of lines on ``min_sites`` or more distinct sites, and the smallest id that has them."""
    sketched = lines.groupBy("key").agg(
        F.hll_sketch_agg("__site", F.lit(lg_k)).alias("sites"), F.min("__id").alias("first_id")
    )
    estimate = sketched.select("key", "first_id", F.hll_sketch_estimate("sites").alias("n"))
    low, high = min_sites * (1 - band) - 1, min_sites * (1 + band) + 1
    spread = written(estimate.filter(F.col("n") >= low), "spread")
    near = spread.filter(F.col("n") <= high)
    # Exact counts: distinct (line, site) first, so that no task gathers all rows of a hot line.
    exact = (
        lines.select("key", "__site")
        .filter(F.col("__site").isNotNull())
        .join(near.select("key"), "key", "left_semi")
        .distinct()
        .groupBy("key")
        .agg(F.count("*").alias("exact"))
        .filter(F.col("exact") >= min_sites)
    )
    return written(
        spread.filter(F.col("n") > high)
        .select("key", "first_id")
        .unionByName(near.join(exact, "key").select("key", "first_id")),
        "boilerplate",
    )


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = 5,
    lg_k: int = 11,
    band: float = 0.25,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``n_lines``, ``n_removed`` (lines).

    A line is boilerplate if it has a word and stands, character by character, in documents of
    ``min_sites`` or more distinct sites.  The document with the smallest id keeps it, so that no
    text is lost from the corpus; all others lose every occurrence.  ``lg_k``: log2 of the sketch's
    registers (11: 2.3 % standard error); lines within ``band`` of the threshold are counted exactly.

    A null site counts for none; a null or empty text stays as it is; documents with a null id never
    keep a line; rows that share an id are treated alike.  Columns that are named as the new ones
    are replaced.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(site_col).alias("__site"), F.col(text_col).alias("__text"))
    lines = lines_of(rows)
    common = boilerplate(lines, min_sites, lg_k, band)
    other = ~F.col("__id").eqNullSafe(F.col("first_id"))
    hits = (
        lines.join(common, "key")
        .filter(other)
        .groupBy("__id")
        .agg(F.collect_set("key").alias("__hits"))
    )
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.select(*kept).join(hits, F.col(id_col).eqNullSafe(F.col("__id")), "left")
    split = F.split(text_col, "\n", -1)
    stays = F.filter(split, lambda x: ~F.coalesce(F.array_contains("__hits", line_key(x)), F.lit(False)))
    cleaned = F.when(F.col("__hits").isNull(), F.col(text_col)).otherwise(F.array_join(stays, "\n"))
    size = F.coalesce(F.size(split), F.lit(0))
    left = F.when(F.col("__hits").isNull(), size).otherwise(F.size(stays))
    return joined.select(
        *[cleaned.alias(text_col) if c == text_col else F.col(c) for c in kept],
        F.when(F.col(text_col).isNull(), 0).otherwise(size).cast("long").alias("n_lines"),
        F.when(F.col(text_col).isNull(), 0).otherwise(size - left).cast("long").alias("n_removed"),
    )


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents
), common AS (
  SELECT line, min(doc_id) AS first_id FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY line HAVING count(DISTINCT source) >= 5
), hits AS (
  SELECT doc_id, list(DISTINCT line) AS hit FROM lines JOIN common USING (line)
  WHERE doc_id <> first_id GROUP BY doc_id
), kept AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts,
         list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(hit, []), x)) AS stay
  FROM documents LEFT JOIN hits USING (doc_id)
)
SELECT doc_id, array_to_string(stay, chr(10)) AS text,
       CAST(len(parts) AS BIGINT) AS n_lines, CAST(len(parts) - len(stay) AS BIGINT) AS n_removed
FROM kept
"""
