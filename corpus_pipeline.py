"""A training corpus in five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import bpe_codec, language_id, ngram_join, pii, source_mix
from llm.common import bound_batches, table
from salesmart.operators.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter, and those in a
    script that no learned language uses. The others stay, mixed ones too; a missing
    ``lang`` is filled in."""
    bound_batches(spark)
    found = language_id.identify(docs, language_id.train_on_folds(docs), carry=COLUMNS[1:])
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") > 0)) \
        .withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest id stays, or one without
    an id where none has one. Of rows that repeat an id and a text one stays; unrelated
    texts stay, also under one id."""
    return ngram_join.one_of_each(docs).select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets."""
    bound_batches(spark)
    found = pii.find_spans(docs, pii.built_in_crf(spark), carry=["lang", "source"])
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source",
                        F.length("redacted").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token weights meet the target shares."""
    return source_mix.mix(docs).where("sampled").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    bound_batches(spark)
    return bpe_codec.digests(bpe_codec.encode_documents(docs), carry=["ids"])


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", one_of_each_group),
    ("pii", hide_personal_data),
    ("source_mix", mix_sources),
    ("bpe_codec", encode),
]

#: Language models, joins of similar texts and the CRF are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
