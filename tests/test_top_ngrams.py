"""The most frequent n-grams by two passes are those of a full count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vacancy_lake.operators import ngrams


def texts(spark, flat=False):
    rng = random.Random(9)
    words = [f"word{k}" for k in range(400)]
    weights = [1 if flat else 1 / (k + 1) ** 1.2 for k in range(400)]
    rows = [(" ".join(rng.choices(words, weights, k=rng.randrange(40))),) for _ in range(600)]
    return spark.createDataFrame([*rows, (None,), ("",)], "t string").repartition(6)


def plain(df, most=3, least=3, limit=20):
    counts = Counter()
    for r in df.collect():
        w = (r.t or "").split()
        counts.update(" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1))
    kept = sorted(((-c, g) for g, c in counts.items() if c >= least))[:limit]
    return [(g, -c) for c, g in kept], counts


@pytest.mark.parametrize("shares", [(5e-3, 1e-3), (1e-4,), (0.2,), ()])
@pytest.mark.parametrize("flat", [False, True])
def test_top_equals_full_count(spark, shares, flat):
    df = texts(spark, flat).cache()
    want, _ = plain(df)
    assert [tuple(r) for r in ngrams.ngram_counts(df, F.col("t"), limit=20, shares=shares).collect()] == want


def test_bounds_hold_and_little_is_sent(spark):
    df = texts(spark).cache()
    _, counts = plain(df)
    found = {r.gram: r.n for r in ngrams.heavy_hitters(df.select(F.array_join(ngrams.tokens(F.col("t")), " ")), 3, 1e-3).collect()}
    lost = found.pop(None)
    assert 0 < lost < 0.02 * sum(counts.values())
    assert all(found.get(g, 0) <= n <= found.get(g, 0) + lost for g, n in counts.items())
    assert 10 * len(found) < len(counts)


def test_ties_and_few_rows(spark):
    df = spark.createDataFrame([("bbb aaa",), ("aaa bbb",), ("ccc",)], "t string")
    got = [tuple(r) for r in ngrams.ngram_counts(df, F.col("t"), min_count=1, limit=3, shares=(0.1,)).collect()]
    assert got == plain(df, least=1, limit=3)[0]
    assert ngrams.ngram_counts(df.filter("false"), F.col("t")).count() == 0
