"""Exact de-duplication by progressive refinement, with column functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm.common import spread, stored

# Characters of the prefix that is hashed in the second step.
PREFIX = 64
# Rows of a length, a prefix or a text meet in so many parts, told by their ids, so that a value
# that a third of all rows have is never one task's alone.
PARTS = 64


def _content(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _steps(id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    text = _content(text_col)
    return (
        F.octet_length(text).alias("__length"),
        F.xxhash64(F.substring(text, 1, PREFIX)).alias("__prefix"),
        (spread(id_col) % PARTS).cast("int").alias("__part"),
    )


def _repeated(spark: SparkSession, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Values of ``keys`` that more than one row has, with each part that such a row is in."""
    parts = rows.groupBy(*keys, "__part").agg(F.count("*").alias("__rows"))
    parts = stored(spark, parts, "dedup-parts")
    several = parts.groupBy(*keys).agg(F.sum("__rows").alias("__all")).where("__all > 1")
    return parts.join(several, keys, "left_semi").drop("__rows")


def _surviving(spark: SparkSession, signs: DataFrame) -> DataFrame:
    """Lengths and prefix hashes that more than one row has, of the lengths that more than one row has."""
    lengths = _repeated(spark, signs, ["__length"])
    rows = signs.join(lengths, ["__length", "__part"], "left_semi")
    return stored(spark, _repeated(spark, rows, ["__length", "__prefix"]), "dedup-groups")


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _classified(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str]) -> DataFrame:
    """``__id, __carry, keep_id, group_size, kept`` and the full hash, null where none was needed."""
    steps = _steps(id_col, text_col)
    carried = (F.struct(*carry) if carry else F.lit(0)).alias("__carry")
    rows = docs.select(F.col(id_col).alias("__id"), carried, *steps)
    signs = stored(spark, rows, "dedup-signs")
    groups = _surviving(spark, signs)
    read = docs.select(
        F.col(id_col).alias("__id"), _content(text_col).alias("__text"), carried, *steps
    ).join(groups, ["__length", "__prefix", "__part"], "left_semi")
    hashed = stored(
        spark, read.select("__id", "__carry", "__part", _hash(F.col("__text")).alias("__hash")), "dedup-hashes"
    )
    # Rows equal in text, id and what is carried: one row for each, with how many there are.
    alike = hashed.groupBy("__hash", "__part", "__id", "__carry").agg(F.count("*").alias("__times"))
    row = F.struct("__id", "__carry")
    parts = hashed.groupBy("__hash", "__part").agg(F.max(row).alias("__most"), F.count("*").alias("__rows"))
    parts = stored(spark, parts, "dedup-parts")
    best = parts.groupBy("__hash").agg(F.max("__most").alias("__keep"), F.sum("__rows").alias("group_size"))
    found = alike.join(parts.select("__hash", "__part").join(best, "__hash"), ["__hash", "__part"])
    first = row.eqNullSafe(F.col("__keep"))
    found = found.withColumn("__copy", F.explode(F.expr("sequence(1L, __times)"))).select(
        "__id", "__carry", F.col("__keep.__id").alias("keep_id"), "group_size",
        (first & (F.col("__copy") == 1)).alias("kept"), "__hash",
    )
    alone = signs.join(groups, ["__length", "__prefix", "__part"], "left_anti").select(
        "__id", "__carry", F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lit(None).cast("binary").alias("__hash"),
    )
    return alone.unionByName(found)


def exact_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Which documents repeat another's whole text.

    Returns ``id, keep_id, group_size, kept`` for every row, with the columns named in ``carry``. Of
    equal texts the row with the largest id stays (null ids come before all others); of rows equal in
    text and id, one with the largest carried values. Each row keeps its own; they must have an order. Null counts as empty. Texts are grouped by length, then by the hash of their
    first characters; only those still in a group with others are read in full and hashed with
    SHA-256. Rows of a group are counted where they lie before they move, groups meet in parts, and
    none is ever gathered. Columns that are neither named nor carried are not looked at.
    """
    rows = _classified(spark, docs, id_col, text_col, carry)
    carried = [F.col("__carry")[name].alias(name) for name in carry]
    return rows.select(F.col("__id").alias(id_col), *carried, "keep_id", "group_size", "kept")


def without_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that stay, with all their columns.

    They are told by their ids. Where an id has rows that stay and rows that go, its rows are told
    by id and text, and rows equal in both count as one.
    """
    rows = _classified(spark, docs, id_col, text_col, ())
    gone = rows.where(~F.col("kept")).select(F.col("__id").alias("__gone"), F.col("__hash").alias("__of"))
    gone = stored(spark, gone.distinct(), "dedup-gone")
    kept = rows.where("kept").select(F.col("__id").alias("__gone"), F.col("__hash").alias("__of"))
    # Nulls are an id like any other.
    ids = gone.select(F.col("__gone").alias("__left")).distinct()
    mixed = kept.join(ids, F.col("__gone").eqNullSafe(F.col("__left")), "left_semi")
    mixed = stored(spark, mixed.distinct(), "dedup-mixed")
    clean = docs.join(ids, F.col(id_col).eqNullSafe(F.col("__left")), "left_anti")
    if mixed.isEmpty():
        return clean
    both = mixed.select(F.col("__gone").alias("__left")).distinct()
    again = docs.join(both, F.col(id_col).eqNullSafe(F.col("__left")), "left_semi")
    again = again.withColumn("__hash", _hash(_content(text_col)))
    # A text that stays has no hash if it is the only one of its kind, so no row that goes equals it.
    stays = mixed.where("__of IS NOT NULL").select(F.col("__gone").alias("__left"), F.col("__of").alias("__text"))
    lost = gone.join(
        stays, F.col("__gone").eqNullSafe(F.col("__left")) & (F.col("__of") == F.col("__text")), "left_anti"
    )
    same = F.col(id_col).eqNullSafe(F.col("__gone")) & (F.col("__hash") == F.col("__of"))
    again = again.join(lost, same, "left_anti")
    return clean.unionByName(again.dropDuplicates([id_col, "__hash"]).drop("__hash"))
