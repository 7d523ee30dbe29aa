"""A corpus pipeline: language, exact copies, near copies, a mix of sources, packed sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm import exact_dedup, jaccard, language_id, mixing, packing
from wattfold.llm.common import limit_batches, stored

TOKENIZER = "word_bpe_49k.json"
# Bytes of text that a worker encodes at once, and words whose ids it keeps: few, as an executor's heap has grown over the
# stages before and its workers share what is left.
ENCODE_BYTES, ENCODE_PARTS = 1 << 18, 150_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents and refuse those without a language."""
    limit_batches(spark)  # for good, as it is the caller who reads the documents that are returned
    model = language_id.fit(spark, docs)
    found = docs.withColumn("__found", language_id.identify(spark, model, F.col("text")))
    return found.where(language_id.accepted(F.col("__found"))).drop("__found")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each text, the one with the largest id."""
    return exact_dedup.without_duplicates(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies, the one with the least id."""
    return jaccard.one_of_each(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents by their sources' weights, some more than once, cut at the exact budget."""
    return mixing.mixed_documents(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 tokens."""
    file = public_tokenizers.path(TOKENIZER)
    return packing.pack_documents(spark, docs, file, block_bytes=ENCODE_BYTES, cached_parts=ENCODE_PARTS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]

# Language ID learns filters and packing merges tokens, neither of which SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
