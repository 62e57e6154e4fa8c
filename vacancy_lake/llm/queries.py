"""The numbered operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fertility, imatch, katz, language, licences, line_dedup, merkle, prefix_trie, records, simhash, url_filter

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where this machine keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(of: int) -> Column:
    """The contract's held-out documents; one without an id is never trained on."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of)) == 2, F.lit(True))


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {"piece": vocabulary("piece_bpe_32k.model"), "byte": vocabulary("byte_bpe_multi_50k.tiktoken")}
    return fertility.quality_rules(table(spark, sf_dir, "documents"), paths)


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(table(spark, sf_dir, "documents"), held_out(7))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.RULES)


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.remove_boilerplate(docs).select("doc_id", "text", "n_lines", "n_removed")


def op8_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return records.read_records(records.write_records(docs, vocabulary("byte_bpe_50k.json"), end_id=2))


def op9_cgk_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~held_out(4)))
    found = language.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score")


def op11_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.neighbour_likeness(table(spark, sf_dir, "documents"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.dataset_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_fertility": op1_fertility,
    "op2_licences": op2_licences,
    "op3_bpe": op3_bpe,
    "op4_katz": op4_katz,
    "op5_simhash": op5_simhash,
    "op6_url_rules": op6_url_rules,
    "op7_line_spread": op7_line_spread,
    "op8_records": op8_records,
    "op9_cgk_leaks": op9_cgk_leaks,
    "op10_crf": op10_crf,
    "op11_imatch": op11_imatch,
    "op12_trie": op12_trie,
    "op13_merkle": op13_merkle,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op6_url_rules": url_filter.ORACLE,
    "op7_line_spread": line_dedup.ORACLE,
    "op12_trie": prefix_trie.ORACLE,
    "op13_merkle": merkle.ORACLE,
}
