"""Connected components: links are contracted where they lie, then joined by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm.common import stored

# Links that one task contracts.
TASK_LINKS = 500_000


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as links of each node to the least one that it leads to within the task."""
    above: dict[int, int] = {}

    def top(node: int) -> int:
        while above.setdefault(node, node) != node:
            above[node] = node = above[above[node]]
        return node

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = top(a), top(b)
            above[max(a, b)] = min(a, b)
    nodes = [node for node in above if top(node) != node]
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([top(node) for node in nodes], pa.int64())], ["u", "v"]
    )


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``id, component``: the least id that links ``a, b`` lead to, for every id that is not the least.

    ``links`` must be a stored table. Tasks of about ``TASK_LINKS`` links contract their own into stars;
    they are cut as ranges, so a node with more links than that is in several. If one task has all,
    that is the result. Else stars are joined in rounds, each of which links all
    larger neighbours of a node to the least of its neighbours, then all smaller ones, until nothing
    changes; links are stored after each round. No component is gathered.
    """
    tasks = max(1, -(-links.count() // TASK_LINKS))
    edges = links.coalesce(1) if tasks == 1 else links.repartitionByRange(tasks, F.least("a", "b"), F.greatest("a", "b"))
    edges = stored(spark, edges.mapInArrow(_contract, "u long, v long"), "component-edges")
    if tasks > 1:
        edges = _stars(spark, edges)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _stars(spark: SparkSession, edges: DataFrame) -> DataFrame:
    edges = stored(spark, edges.distinct(), "component-edges")
    sign = _sign(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(spark, large.where("u != v").distinct(), "component-edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(spark, small.union(least).distinct(), "component-edges")
        before, sign = sign, _sign(edges)
        if sign == before:
            return edges
