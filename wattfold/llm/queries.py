"""The registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm import (
    chat, context_mixing, exact_dedup, jaccard, language_id, mixing, neighbours, packing, sharding, spelling, token_files,
    turn_repair, warc,
)
from wattfold.settings import scratch_dir

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
SHARDS = 8
NEIGHBOURS = 5
# A conversation of control strings, added to the table.
ODD_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; those with crc32 of the id 2 modulo 4 are held out of learning."""
    docs = _table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.fit(spark, docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language_id.identify(spark, model, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", "found.*")


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text and its loss mask."""
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, 0, "user", ODD_TEXT), (-1, 1, "assistant", ODD_TEXT)], turns.schema)
    chats = chat.format_chats(turns.unionByName(odd))
    read = chats.select(
        "conv_id",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("mask")).alias("learned"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents that share 85 in 100 of their four-word shingles."""
    return jaccard.similar_documents(spark, _table(spark, folder, "documents"), words=4, percent=85)


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes, equal texts together."""
    rows = sharding.shard_documents(spark, _table(spark, folder, "documents"), SHARDS)
    return rows.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' tokens packed into sequences of 2048."""
    return packing.pack_documents(spark, _table(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' tokens, written to binary files and read back."""
    path = scratch_dir(spark, "token-files")
    docs = _table(spark, folder, "documents")
    token_files.write_token_files(spark, docs, path, public_tokenizers.path(BYTE_TOKENIZER))
    return token_files.read_token_files(spark, path)


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document a mix of the sources by weight takes."""
    rows = mixing.mix(spark, _table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents repeat another's whole text; every text's digest is carried along."""
    docs = _table(spark, folder, "documents")
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    return exact_dedup.exact_duplicates(spark, docs, carry=["text_sha256"])


def op9_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """The metadata and conversion records of all pages' response records."""
    pages = warc.responses(_table(spark, folder, "pages"))
    return warc.derivatives(pages, keep=("id",)).withColumnRenamed("id", "page_id")


def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one, by cosine."""
    vectors = _table(spark, folder, "embeddings")
    return neighbours.nearest(spark, vectors, neighbours.every_nth(vectors), NEIGHBOURS, neighbours.FACTOR)


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired turns of every damaged conversation."""
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = turn_repair.repair(spark, turn_repair.damaged(turns))
    digests = turn_repair.repaired_digests(spark, repaired).withColumnRenamed("conv_id", "__conv")
    report = report.withColumnRenamed("conv_id", "__of")
    rows = turns.select("conv_id").distinct()
    rows = rows.join(report, F.col("conv_id").eqNullSafe(F.col("__of")), "left")
    rows = rows.join(digests, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return rows.select(
        "conv_id", *[F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their near words, the form each is a variant of and that form's root."""
    return spelling.spelling_variants(spark, _table(spark, folder, "documents"))


def op13_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and context-mixing scores of all documents; a tenth, by crc32 of the id, is held out of learning."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = _table(spark, folder, "documents").select("doc_id", "text", (F.crc32(name.cast("binary")) % 10 == 0).alias("held_out"))
    return context_mixing.score(spark, docs)


def _reachable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Let Python workers find this package where the driver does; clusters ship it with ``--py-files``."""

    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
        environment = spark.sparkContext.environment
        paths = environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_chat_format": op2_chat_format,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_sharding": op4_sharding,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_token_files": op6_token_files,
    "op7_source_mix": op7_source_mix,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc_derivatives": op9_warc_derivatives,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_structure_repair": op11_structure_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_lm_score": op13_lm_score,
    "pipeline": corpus_pipeline.run,
}
QUERIES = {name: _reachable(query) for name, query in QUERIES.items()}
