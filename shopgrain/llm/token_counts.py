"""Token counts through a cache keyed by content digest and tokenizer version.

A document's digest is taken over its normalised content (see ``Counter``), so equal digests have equal counts.
Digests that the cache lacks are encoded once each, whatever the number of copies, and appended to it; then
every document takes its count from the cache. Texts travel only for digests that are missing, one per
digest and task. The cache is a Parquet table partitioned by tokenizer version; it may hold a digest
twice, if two runs append at the same time, with the same count.

Rows: null text is empty text with 0 bytes and 0 tokens. Repeated rows each come out. Input columns other
than the id and the text are left out, so no name can clash.
"""

import hashlib
from collections.abc import Iterator
from functools import cache as memo
from pathlib import Path

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer

from shopgrain.llm import bpe
from shopgrain.llm.batches import given_back, text_slices, texts_of
from shopgrain.operators.lookup import salted_join
from shopgrain.sources.scratch import materialise, path_exists

DIGEST_BYTES = 16
FILTER_ROWS = 200_000  # so many missing digests (of 16 bytes) are broadcast to filter the texts


class Counter:
    """Counts of one tokenizer file: own BPE for word vocabularies, else the file's library."""

    def __init__(self, path: str):
        self.path = path
        try:
            self.words = bpe.model(path) if path.endswith(".json") else None
        except (KeyError, TypeError, ValueError):
            self.words = None
        if self.words is None and path.endswith(".json"):
            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
        elif self.words is None:
            self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def normalised(self, text: Column) -> Column:
        """Content that decides the count: a word vocabulary drops white space, others see it all."""
        if self.words is None:
            return text
        return F.trim(F.regexp_replace(text, r"[\t-\r ]+", " "))

    def forget(self) -> None:
        if self.words is not None:
            self.words.forget()

    def count(self, texts: list[str]) -> list[int]:
        if self.words is not None:
            starts = self.words.encode(texts)[1]
            return (starts[1:] - starts[:-1]).tolist()
        if isinstance(self.library, Tokenizer):
            found = self.library.encode_batch_fast(texts, add_special_tokens=False)
            return [len(x) for x in found]
        return [len(x) for x in self.library.encode(texts, num_threads=1)]


@memo
def counter(path: str) -> Counter:
    """One counter per file and worker."""
    return Counter(path)


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: another file, another version."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()[:32]


def cached_counts(spark, cache_path: str, version: str) -> DataFrame:
    """digest, n_tokens of one tokenizer version; empty if nothing is stored yet."""
    schema = "digest binary, n_tokens bigint, tokenizer string"
    if path_exists(spark, cache_path):
        stored = spark.read.schema(schema).parquet(cache_path)
    else:
        stored = spark.createDataFrame([], schema)
    return (
        stored.where(F.col("tokenizer") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """id, n_bytes, n_tokens of every document; encodes what the cache lacks and appends it."""
    spark = docs.sparkSession
    version, rules = tokenizer_version(tokenizer_path), counter(tokenizer_path)
    text = F.coalesce(F.col(text_column), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(rules.normalised(text), 256)), 1, DIGEST_BYTES)
    seen = materialise(
        docs.select(
            F.col(id_column).alias("id"),
            F.octet_length(text).cast("bigint").alias("n_bytes"),
            digest.alias("digest"),
        ),
        "digests",
    )
    known = cached_counts(spark, cache_path, version)
    missing = materialise(
        seen.select("digest").distinct().join(known, "digest", "left_anti"), "missing"
    )
    misses = missing.count()
    if misses:
        texts = docs.select(digest.alias("digest"), text.alias("text"))
        if misses <= FILTER_ROWS:
            texts = texts.join(F.broadcast(missing), "digest", "left_semi")
        distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
        if misses > FILTER_ROWS:
            distinct = distinct.join(missing, "digest", "left_semi")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = counter(tokenizer_path)
            with given_back(own.forget):
                for batch in text_slices(batches, "text"):
                    counts = pa.array(own.count(texts_of(batch, "text")), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("digest"), counts], ["digest", "n_tokens"]
                    )

        (
            distinct.mapInArrow(count, "digest binary, n_tokens bigint")
            .withColumn("tokenizer", F.lit(version))
            .write.mode("append")
            .partitionBy("tokenizer")
            .parquet(cache_path)
        )
    # Copies share a digest; frequent ones are spread.
    counted = salted_join(seen, cached_counts(spark, cache_path, version), ["digest"])
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens")
