"""A corpus from raw documents to token ids: five stages, each over all that the one before kept."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopgrain.llm import bpe, language_id, mixing, near_dedup, quality
from shopgrain.sources.scratch import materialise

VOCABULARY = "word_bpe_49k.json"
LEAST_LANGUAGE_SCORE = 0.6  # measured on held-out and on foreign texts, see the README


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those of a window or more in which no learned language prevails."""
    network = language_id.learn(docs, language_id.Shape(), "doc_id", "text", "lang")
    return language_id.known_language(docs, network, LEAST_LANGUAGE_SCORE)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, learned from the labels of these documents, scores low."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = quality.learn(docs, labels, quality.Shape(), "doc_id", "text", "quality")
    return quality.good_documents(docs, network)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near_dedup.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it, also not at all."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded (the ids' text) of every document."""
    coded = bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language ID", known_languages),
    ("quality classifier", good_quality),
    ("near-duplicates", without_near_duplicates),
    ("mixing", mixed_sources),
    ("BPE", token_ids),
]

#: SQL has neither the learned models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
