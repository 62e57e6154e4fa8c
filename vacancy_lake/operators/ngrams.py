"""Keyword candidates: tokens, n-gram counts, filters."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: Words that name no skill.
STOPWORDS = [
    "experience", "requirement", "description", "job", "work", "team", "skill",
    "ability", "knowledge", "proficiency", "familiar", "understanding",
    "strong", "good", "excellent", "basic", "advanced", "intermediate",
    "có", "kinh", "nghiệm", "yêu", "cầu", "ứng", "viên", "thành", "thạo",
    "hiểu", "biết", "tốt", "nghiệp", "vụ", "chuyên", "môn", "vị", "trí",
    "công", "việc", "và", "hoặc", "với", "cho", "của", "một", "các", "những",
    "từ", "đến", "trong", "ngoài", "trên", "dưới", "theo", "qua", "bằng",
    "được", "có", "không", "cũng", "đã", "sẽ", "đang", "là", "ở",
]


def tokens(text: Column, stopwords: list[str] = STOPWORDS) -> Column:
    """ASCII words of over two characters; stop words are tested before lower-casing."""
    words = F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9]+(?:[-_][A-Za-z0-9]+)*"), F.lit(0))
    # A set of literals is asked by hash, an array word by word.
    kept = F.filter(words, lambda t: (F.length(t) > 2) & ~t.isin(list(dict.fromkeys(stopwords))))
    return F.transform(kept, F.lower)


def ngrams_of(words: Column, most: int = 3) -> Column:
    """All runs of 1 to ``most`` words."""

    def runs(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.concat(*[runs(n) for n in range(1, most + 1)])


#: Share of a task's words below which a count is not passed on: first try, and second if that leaves the top open.
SHARES = (5e-6, 1e-6)


#: A task hands on its counts when it holds so many different n-grams.
COUNTED = 500_000


def _grams(words: list[str], most: int) -> Iterator[tuple[str, ...]]:
    for n in range(1, most + 1):
        yield from zip(*[words[k:] for k in range(n)], strict=False)


def _joined(counts: dict[tuple[str, ...], int]) -> dict[str, int]:
    """Counted as tuples: only different n-grams are joined, not every place of one."""
    return {" ".join(g): n for g, n in counts.items()}


def _counts(counts: dict[str | None, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])


def heavy_hitters(words: DataFrame, most: int, share: float) -> DataFrame:
    """gram, n: lower bounds of the counts in ``words`` (a column of words joined by spaces), and one row with a null gram.

    Each task keeps as many counters as can have over ``share`` of its n-grams; where more are needed, all are
    lessened and the smallest go.  By no more than the null row's n is any count too low, a missing one's too.
    """
    room = int(1 / share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, lost = Counter(), 0, 0
        for batch in batches:
            for row in batch.column(0).to_pylist():
                words = row.split() if row else []
                counts.update(words if most == 1 else map(" ".join, _grams(words, most)))
                seen += sum(max(0, len(words) - n) for n in range(most))
                if len(counts) > 4 * room:
                    values = np.fromiter(counts.values(), np.int64, len(counts))
                    less = int(np.partition(values, len(values) - room)[len(values) - room])
                    counts = Counter({g: n - less for g, n in counts.items() if n > less})
                    lost += less
        least = int(share * seen)
        yield _counts({g: n for g, n in counts.items() if n > least} | {None: lost + least})

    found = words.mapInArrow(run, "gram string, n long")
    return found.groupBy("gram").agg(F.sum("n").alias("n"))


def _heavy_words(words: DataFrame, limit: int, shares: Sequence[float]) -> list[str] | None:
    """All words that an n-gram among the ``limit`` most frequent may have; None if the bounds leave that open.

    The last of the ``limit`` first words has some count; that of the last n-gram is no smaller, as words are n-grams,
    and no n-gram stands more often than its words.
    """
    for share in shares:
        folder = scratch_path(words.sparkSession, "words")
        heavy_hitters(words, 1, share).write.parquet(folder)
        found = words.sparkSession.read.schema("gram string, n long").parquet(folder)
        lost = found.filter("gram IS NULL").agg(F.sum("n")).first()[0] or 0
        top = found.filter("gram IS NOT NULL").orderBy(F.desc("n")).limit(limit).agg(F.min("n"), F.count("*")).first()
        # Beyond twice what may be lost no word can be missing, and at most one for each ``lost`` words reaches it.
        if top[1] == limit and top[0] > 2 * lost:
            return [r.gram for r in found.filter(F.col("gram").isNotNull() & (F.col("n") + lost >= top[0])).collect()]
    return None


def _counts_of_heavy(words: DataFrame, most: int, heavy: list[str]) -> DataFrame:
    """gram, count of all n-grams of ``heavy`` words."""
    known = words.sparkSession.sparkContext.broadcast(frozenset(heavy))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, of = Counter(), known.value
        for batch in batches:
            for row in batch.column(0).to_pylist():
                for is_heavy, run in itertools.groupby(row.split() if row else [], of.__contains__):
                    if is_heavy:
                        counts.update(_grams(list(run), most))
            if len(counts) > COUNTED:
                yield _counts(_joined(counts))
                counts = Counter()
        yield _counts(_joined(counts))

    return words.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("count"))


def ngram_counts(
    df: DataFrame, text: Column, most: int = 3, min_count: int = 3, limit: int | None = 500, shares: Sequence[float] = SHARES
) -> DataFrame:
    """gram, count of the most frequent n-grams, counted within rows; equals by gram.

    Two passes: bounded counters give all words that the ``limit`` first can have, then only n-grams of these are
    counted, exactly.  Where the bounds do not tell them from the rest, and without a limit, all n-grams are counted.
    """
    split = df.select(tokens(text).alias("words"))
    words = split.select(F.array_join("words", " ").alias("words"))
    heavy = _heavy_words(words, limit, shares) if limit else None
    if heavy is not None:
        counted = _counts_of_heavy(words, most, heavy)
    else:
        grams = split.select(F.explode(ngrams_of(F.col("words"), most)).alias("gram"))
        counted = grams.groupBy("gram").agg(F.count("*").alias("count"))
    ordered = counted.filter(F.col("count") >= min_count).orderBy(F.desc("count"), "gram")
    return ordered.limit(limit) if limit else ordered


def candidates(counts: DataFrame) -> DataFrame:
    """n-grams that can name a skill: not a number, not short and rare."""
    gram, n = F.col("gram"), F.col("count")
    short = ~gram.contains(" ") & (F.length(gram) < 4) & (n < 5)
    return counts.filter(~gram.rlike(r"^\d+$") & (F.length(gram) > 2) & ~short).orderBy(F.desc("count"), "gram")


def combined_text(*columns: Column) -> Column:
    """Texts joined by a space, null as empty."""
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns])


def null_counts(df: DataFrame) -> DataFrame:
    """Rows, and nulls of each column: one row, one pass."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns])
