"""From raw documents to token ids: every stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancy_lake.llm import bpe, decontaminate, language, line_dedup, simhash
from vacancy_lake.llm.queries import held_out, vocabulary
from vacancy_lake.llm.store import written

#: A text stays if one language holds this share of its letters; code-switched and odd texts in a
#: known language do, texts without letters and texts of no known language do not.
LEAST_SCORE = 0.4
#: Near-duplicates share this much of their five-word shingles.
SHINGLE, SIMILARITY = 5, 0.8


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the labeller tells; it learns from the labelled ones."""
    model = language.fit(docs.filter(~held_out(4)))
    return language.keep_known(docs, model, LEAST_SCORE)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of many sites; those left without a word go.

    A document that no line left is kept as it was, a null or empty text included.
    """
    cleaned = line_dedup.remove_boilerplate(docs)
    left = cleaned.filter((F.col("n_removed") == 0) | line_dedup.has_word(F.col("text")))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


def first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: those with near SimHash fingerprints or a common MinHash
    key are compared by their shingles."""
    return simhash.keep_first(docs, shingle=SHINGLE, similarity=SIMILARITY)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as token ids, with the digests of ids and decoded text.

    A null or empty text has no ids; rows that share an id are encoded each.
    """
    return bpe.encode_digests(docs, vocabulary("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("language", known_language),
    ("line_dedup", without_boilerplate),
    ("near_dedup", first_of_group),
    ("decontamination", without_benchmark),
    ("bpe", encode),
]

#: SQL has neither the labeller nor the fingerprints' groups; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
