"""What several operators share: stored intermediate tables, running sums, slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, MutableMapping, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattfold.settings import byte_count, scratch_dir

# A word is a run of anything but these blanks: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
# Rows that one task orders for a running sum.
CHUNK_ROWS = 50_000
# Bytes of text that a Python worker turns into words at once.
BLOCK_BYTES = 1 << 18
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
# Bytes of rows that go to a Python worker at once, about. Spark's 10,000 rows are 35 MB of whole texts, for which the
# JVM doubles its buffers until they fit, outside of its heap, and the worker has its own.
BATCH_BYTES = 1 << 20
# What operators keep in a worker from task to task: tables that can be made again.
KEPT: list[MutableMapping] = []


def limit_batches(spark: SparkSession) -> str:
    """From now on, the session's batches to Python workers have about ``BATCH_BYTES``; returns its limit so far.

    A smaller limit stays.
    """
    before = spark.conf.get(_BATCH_LIMIT)
    spark.conf.set(_BATCH_LIMIT, min(byte_count(before), BATCH_BYTES))
    return before


def small_batches(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``work`` with such batches for all that it stores; the session, its first argument, gets its limit back."""

    @wraps(work)
    def limited(spark: SparkSession, *args, **kwargs) -> DataFrame:
        before = limit_batches(spark)
        try:
            return work(spark, *args, **kwargs)
        finally:
            spark.conf.set(_BATCH_LIMIT, before)

    return limited


def drop_kept() -> None:
    """Free, in a worker, what tasks of other operators have kept there."""
    for table in KEPT:
        table.clear()
    pa.default_memory_pool().release_unused()


def stored(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: computed once, and safe from lost executors."""
    path = scratch_dir(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def spread(*columns: Column | str) -> Column:
    """A hash of the columns as a long from 0 to 2^31 - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 33)


def running_sum(
    rows: DataFrame, keys: Sequence[str], at: str, order: Sequence[str], value: Column, name: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows of the same keys that come before the row.

    Rows are ordered by ``at``, a long that is spread evenly over 0 to 2^31 - 1, then by ``order``.
    The span of ``at`` is cut into ranges of about ``chunk_rows`` rows; sums of whole ranges are
    added up first, so no task orders more than one range of one key, however many rows a key has.
    Nulls are a key like any other.
    """
    chunks = max(1, -(-rows.count() // chunk_rows))
    rows = rows.withColumn("__chunk", F.floor(F.col(at) * F.lit(chunks) / F.lit(1 << 31)).cast("int"))
    sums = rows.groupBy(*keys, "__chunk").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(key).alias(f"__{key}") for key in keys],
        F.col("__chunk").alias("__of"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"),
    )
    same = F.col("__chunk") == F.col("__of")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
    within = (
        Window.partitionBy(*keys, "__chunk").orderBy(at, *order).rowsBetween(Window.unboundedPreceding, -1)
    )
    total = F.coalesce(F.sum(value).over(within), F.lit(0)) + F.col("__before")
    return rows.join(sums, same).withColumn(name, total).select(*rows.drop("__chunk").columns, name)


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += int(size)
        if first < batch.num_rows:
            yield batch.slice(first)


def mix64(value: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers under which every bit depends on all bits."""
    value = (value ^ (value >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    value = (value ^ (value >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return value ^ (value >> np.uint64(33))
