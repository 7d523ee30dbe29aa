"""JDBC source and sink. Connection details come from the caller."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Ranges(NamedTuple):
    """How to cut a JDBC scan into parallel range queries on a numeric or date column."""

    column: str
    lower: object
    upper: object
    partitions: int


def scan_options(url: str, query: str, ranges: Ranges | None = None, fetch_rows: int = 10_000) -> dict[str, str]:
    """Options of a scan; a subquery goes to the database in parentheses, with an alias."""
    query = query.strip()
    is_subquery = query.lower().startswith(("select", "with"))
    options = {"url": url, "dbtable": f"({query}) AS subquery" if is_subquery else query}
    options["fetchsize"] = str(fetch_rows)
    if ranges is not None:
        options |= {
            "partitionColumn": ranges.column,
            "lowerBound": str(ranges.lower),
            "upperBound": str(ranges.upper),
            "numPartitions": str(ranges.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str],
    ranges: Ranges | None = None,
) -> DataFrame:
    """A table or subquery; rows outside the range bounds land in the outer partitions, none are lost."""
    return spark.read.format("jdbc").options(**properties, **scan_options(url, query, ranges)).load()


def append_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str], max_connections: int = 32) -> None:
    """Append by column name, with a bound on the connections that tasks open at once."""
    (
        rows.write.format("jdbc")
        .options(**properties, url=url, dbtable=table, numPartitions=str(max_connections), batchsize="10000")
        .mode("append")
        .save()
    )


def jdbc_batch_writer(url: str, table: str, properties: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that appends to a table.

    A batch repeated after a failure is appended again; ``batch_id`` is written along so that
    readers can keep one copy of each reading.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        from pyspark.sql import functions as F

        append_jdbc(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), url, table, properties)

    return write
