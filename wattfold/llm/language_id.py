"""Language identification with bit-sliced Bloom filters of byte n-grams.

One table holds a Bloom filter for every language: a row per hash value, a bit per language. The rows
that an n-gram's hashes name, ANDed, tell at once which languages may contain it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm.common import mix64, spread, stored, text_blocks

# Lengths of the n-grams, in bytes of lower-cased UTF-8.
SIZES = (3, 5)
# Rows of the filter table, and hashes per n-gram.
ROWS = 1 << 20
HASHES = 3
# Documents that are learned from, per language, at most in expectation.
FIT_DOCUMENTS = 1_000
# An n-gram belongs to a language if at least this many of its documents have it (one, if the language
# has fewer than ``SEVERAL`` that are learned from), and a share of them that is at least so many times
# that of the language that has it most.
LEAST_DOCUMENTS = 2
SEVERAL = 50
LEAST_RATIO = 0.125
# Languages that one table can tell apart.
MOST_LANGUAGES = 64
UNKNOWN = "und"
# A document is refused if less than this share of its n-grams is known in its language.
LEAST_SCORE = 0.2

_SPACE = np.uint8(0x20)
_LETTER = np.zeros(256, np.uint8)
_LETTER[:] = _SPACE
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    """Languages in order of code points, the filter table, and the share of rows each has set."""

    languages: tuple[str, ...]
    table: np.ndarray
    filled: np.ndarray


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' n-grams, and the number of the text each is from.

    Bytes that are no letter of a word (ASCII other than a-z) count as one blank each; an n-gram may
    have a blank at either end, which marks a word's, and none between.
    """
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    # A blank on either side of each text.
    texts = pc.binary_join_element_wise("", texts, "", " ")
    data = np.frombuffer(b"".join([x.as_buffer() for x in texts]), np.uint8) if len(texts) else np.zeros(0, np.uint8)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    data = _LETTER[data]
    of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    blanks = np.concatenate([[0], np.cumsum(data == _SPACE)])
    hashes, owners = [], []
    for size in SIZES:
        n = len(data) - size + 1
        if n <= 0:
            continue
        value = np.zeros(n, np.uint64)
        for k in range(size):
            value |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
        inside = blanks[size - 1 : size - 1 + n] - blanks[1 : 1 + n]
        ends_blank = (data[:n] == _SPACE).astype(np.int8) + (data[size - 1 :] == _SPACE)
        keep = (inside == 0) & (ends_blank < 2) & (of[:n] == of[size - 1 :])
        hashes.append(mix64(value[keep] | np.uint64(size << 56)))
        owners.append(of[:n][keep])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, in order, and how often each occurs."""
    order = np.lexsort((first, second))
    first, second = first[order], second[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    heads = np.flatnonzero(new)
    return first[heads], second[heads], np.diff(np.append(heads, len(first)))


def _places(hashes: np.ndarray, rows: int) -> list[np.ndarray]:
    """The filter rows of n-grams: double hashing with the two halves of the hash."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(k) * high) % np.uint64(rows)).astype(np.int64) for k in range(HASHES)]


def learnable(lang: Column) -> Column:
    return lang.isNotNull() & (lang != "") & (lang != UNKNOWN)


def fit(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = FIT_DOCUMENTS, rows: int = ROWS,
) -> Model:
    """Learn the filters from labelled documents; those without a label or text teach nothing.

    Of each language about ``per_language`` documents, chosen by a hash of their id, are learned
    from, so what is learned from has a bound. The table that comes to the driver has ``rows`` rows
    at most. No labelled documents give a model without languages.
    """
    labelled = docs.where(learnable(F.col(lang_col)) & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    counts = {lang: n for lang, n in labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = tuple(sorted(counts))
    if not languages:
        return Model((), np.zeros(rows, np.uint8), np.zeros(0))
    share = F.element_at(
        F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / counts[lang]))]), F.col("lang")
    )
    chosen = labelled.where(spread("id") < share * F.lit(float(1 << 31)))
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    chosen = chosen.select("text", F.element_at(number, F.col("lang")).alias("language"))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many documents of each language have an n-gram."""
        for block in text_blocks(batches, "text"):
            hashes, owners = grams(block.column("text"))
            language = block.column("language").to_numpy(zero_copy_only=False).astype(np.int64)
            owners, hashes, _ = _distinct(owners, hashes)
            numbers, hashes, n = _distinct(language[owners], hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(numbers.astype(np.int32)), pa.array(n)],
                ["gram", "language", "n"],
            )

    found = chosen.mapInArrow(seen, "gram long, language int, n long")
    found = stored(spark, found.groupBy("gram", "language").agg(F.sum("n").alias("n")), "language-grams")
    sizes = {number: n for number, n in chosen.groupBy("language").count().collect()}
    documents = F.create_map(*[F.lit(x) for number, n in sizes.items() for x in (number, float(n))]) if sizes else None
    if documents is None:
        return Model(languages, np.zeros(rows, np.uint8), np.zeros(len(languages)))
    found = found.withColumn("rate", F.col("n") / F.element_at(documents, F.col("language")))
    # Rare languages are learned too: a language's own documents say how many are asked for.
    found = found.withColumn(
        "enough", (F.col("n") >= LEAST_DOCUMENTS) | (F.element_at(documents, F.col("language")) < SEVERAL)
    )
    top = found.groupBy("gram").agg(
        F.collect_list(F.struct("language", "enough", "rate")).alias("all"), F.max("rate").alias("top")
    )
    member = F.filter("all", lambda x: x["enough"] & (x["rate"] >= F.lit(LEAST_RATIO) * F.col("top")))
    mask = F.aggregate(
        member,
        F.lit(0).cast("long"),
        lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["language"])),
    )
    masks = top.select("gram", mask.alias("mask")).where(F.col("mask") != 0)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("gram").to_numpy().view(np.uint64)
            for place in _places(hashes, rows):
                yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("mask")], ["place", "mask"])

    table = masks.mapInArrow(rows_of, "place long, mask long").groupBy("place").agg(F.bit_or("mask").alias("mask"))
    held = table.toPandas()
    kind = next(t for bits, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64)) if len(languages) <= bits)
    slices = np.zeros(rows, kind)
    slices[held["place"].to_numpy(np.int64)] = held["mask"].to_numpy(np.int64).view(np.uint64).astype(kind)
    filled = np.array([((slices >> kind(i)) & kind(1)).mean() for i in range(len(languages))])
    return Model(languages, slices, filled)


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """For each text and language, the share of the text's n-grams that the language has.

    Shares are corrected for false positives: of the n-grams that a language lacks, the filter lets
    the share of its set rows, to the power of the number of hashes, through.
    """
    hashes, owners = grams(texts)
    mask = None
    for place in _places(hashes, len(model.table)):
        rows = model.table[place]
        mask = rows if mask is None else mask & rows
    total = np.bincount(owners, minlength=len(texts))
    out = np.zeros((len(texts), len(model.languages)))
    for i, filled in enumerate(model.filled):
        bit = (mask >> model.table.dtype.type(i)) & model.table.dtype.type(1)
        hits = np.bincount(owners, weights=bit, minlength=len(texts))
        wrong = filled**HASHES
        share = np.divide(hits, total, out=np.zeros(len(texts)), where=total > 0)
        out[:, i] = np.clip((share - wrong) / (1 - wrong) if wrong < 1 else 0, 0, 1)
    return out


def identify(spark: SparkSession, model: Model, text: Column) -> Column:
    """``struct<lang_pred, score>`` of each whole text.

    The language with the largest corrected share wins, ties go to the first by code point; the share
    is the score. A text that is null or has no letter is ``und`` with score 0, as is any text if the
    model knows no language.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        model = shared.value
        names, best = [], []
        blocks = text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text")
        for block in blocks:
            found = scores(model, block.column("text"))
            first = found.argmax(axis=1)
            names.append(np.array(model.languages, object)[first])
            best.append(found[np.arange(len(first)), first])
        names = pa.array(np.concatenate(names), pa.string()) if names else pa.array([], pa.string())
        best = pa.array(np.concatenate(best), pa.float64()) if best else pa.array([], pa.float64())
        return pa.StructArray.from_arrays([names, best], ["lang_pred", "score"])

    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if not model.languages:
        return unknown
    # The function runs on every row; texts without letters are told by Spark's own expression.
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), predict(text)).otherwise(unknown)


def accepted(language: Column) -> Column:
    """Whether a document is kept: it has a language, and enough of it."""
    return (language["lang_pred"] != UNKNOWN) & (language["score"] >= LEAST_SCORE)
