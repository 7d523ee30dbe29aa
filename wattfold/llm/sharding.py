"""Sharding by longest processing time: whole groups, largest first, to the least-loaded shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm.common import running_sum, spread, stored

# A group of at least the mean shard's size over this is scheduled by itself: at most this many
# groups per shard, whatever the input.
OWN_ITEMS = 1000
# Smaller groups are scheduled in this many bundles.
BUNDLES = 8192


def longest_first(sizes: Iterable[tuple[int, object]], shards: int) -> list[tuple[object, int]]:
    """Give each item, largest first and ties by item, to the shard with the least so far."""
    heap = [(0, shard) for shard in range(shards)]
    placed = []
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed.append((item, shard))
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_documents(
    spark: SparkSession, docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents in shards of nearly equal bytes, equal texts together.

    Returns ``id, size, text_crc32, shard, slot``: bytes of the text plus one, the text's checksum,
    the shard and the row's place in it, without gaps from 0. A null text counts as an empty one and
    stays with empty ones. Repeated rows and null ids each keep a row; other columns are not looked
    at; an empty table gives no rows.

    A group of a thousandth of a shard or more is scheduled by itself. Groups below that are bundled
    by a hash of their text, into bundles that range from next to nothing to twice the mean, so that
    the last items given out are small. The driver holds at most ``shards * OWN_ITEMS`` groups and
    ``BUNDLES`` bundles, which no input can exceed; rows of a large group are numbered in ranges.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        spark,
        docs.select(
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(text, 256)).alias("group"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
        ).withColumn("bundle", F.floor(F.sqrt(spread("group") / F.lit(float(1 << 31))) * F.lit(BUNDLES)).cast("int")),
        "shard-rows",
    )
    groups = stored(spark, rows.groupBy("group", "bundle").agg(F.sum("size").alias("size")), "shard-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    least = max(1, -(-total // (shards * OWN_ITEMS)))
    own = groups.where(F.col("size") >= least).select("size", "group").collect()
    bundles = groups.where(F.col("size") < least).groupBy("bundle").agg(F.sum("size")).collect()
    # Groups are bytes and bundles are numbers: the first part of an item keeps them apart.
    items = [(size, (0, bytes(group), 0)) for size, group in own] + [(size, (1, b"", number)) for number, size in bundles]
    placed = longest_first(items, shards)
    of_group = [(item[1], shard) for item, shard in placed if item[0] == 0]
    of_bundle = [(item[2], shard) for item, shard in placed if item[0] == 1]
    of_group = spark.createDataFrame(of_group, "group binary, own_shard int")
    of_bundle = spark.createDataFrame(of_bundle, "bundle int, bundle_shard int")
    sharded = (
        rows.join(F.broadcast(of_group), "group", "left")
        .join(F.broadcast(of_bundle), "bundle", "left")
        .select(
            "id", "size", "text_crc32",
            F.coalesce("own_shard", "bundle_shard").alias("shard"),
            spread("id", "group").alias("at"),
        )
    )
    numbered = running_sum(sharded, ["shard"], "at", ["id", "text_crc32"], F.lit(1), "slot")
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", F.col("slot").cast("long"))
