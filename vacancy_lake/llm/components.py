"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


LINKS_PER_TASK = 100_000


def _smallest(pairs: DataFrame) -> DataFrame:
    """u, v, m: m is the smallest of u and all of u's neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest node around u."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return _smallest(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u itself, is linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    found = _smallest(down)
    return (
        found.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (columns a, b, comparable and not null).

    ``root`` is the smallest node that can be reached.  Each round is written to the shared folder,
    and the number of rounds grows with the logarithm of the longest chain.  Without links the
    result is empty.
    """
    now = written(links.filter("a <> b").select("a", "b").distinct(), "links")
    # Links are short rows: few of them need few tasks and files, many get as many as any shuffle.
    most = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(most, 1 + now.count() // LINKS_PER_TASK)
    mark = None
    while True:
        now = written(_small_star(_large_star(now)).coalesce(parts), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct().unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = state
