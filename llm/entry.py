"""Queries of the operators over the given tables, and their SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    bpe_codec, divergence, fertility, language_id, lattice_dedup, ngram_join, pii, pivot_search,
    resample, site_quality, source_mix, token_counts, toxicity,
)
from llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def _held_out():
    return F.coalesce(fold() == 0, F.lit(False)).alias("held_out")


def op1_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_piece_tokens", "n_byte_tokens", "piece_chars", "byte_chars",
        "fallback", "entropy", F.array_join("rejected_by", ",").alias("rejected_by"))


def op2_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.char_model(docs)
    evidence = toxicity.learn(docs, labels.where(fold() != 0), model)
    return toxicity.score_documents(docs, model, evidence).select(
        "doc_id", _held_out(), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("restored").cast("long").alias("n_restored"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(bpe_codec.encode_documents(table(spark, sf_dir, "documents")))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(source_mix.NONE)
    return source_mix.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", F.coalesce("source", none).alias("source"), F.coalesce("lang", none).alias("lang"),
        "topic", "n_tokens", F.round("probability", 9).alias("probability"), "sampled")


def op6_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold() != 0)
    found = site_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"), labels)
    return found.select("doc_id", _held_out(), "host", "path", "own", "host_posterior",
                        "path_posterior", "score", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train_on_folds(docs))
    return found.select(
        "doc_id", _held_out(), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op10_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_spans(table(spark, sf_dir, "documents"), pii.built_in_crf(spark)))


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"))


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_fertility_rules": op1_fertility_rules,
    "op2_deobfuscated_toxicity": op2_deobfuscated_toxicity,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_source_mix": op5_source_mix,
    "op6_lattice_dedup": op6_lattice_dedup,
    "op7_site_quality": op7_site_quality,
    "op8_language_id": op8_language_id,
    "op9_token_counts": op9_token_counts,
    "op10_pii_crf": op10_pii_crf,
    "op11_pivot_search": op11_pivot_search,
    "op12_importance_resample": op12_importance_resample,
    "op13_source_divergence": op13_source_divergence,
}

#: These are exact and within reach of SQL; the other operators are not.
ORACLE_SQL: dict[str, str] = {
    "op5_source_mix": source_mix.oracle_sql(),
    "op11_pivot_search": pivot_search.oracle_sql(),
    "op12_importance_resample": resample.oracle_sql(),
    "op13_source_divergence": divergence.oracle_sql(),
}
