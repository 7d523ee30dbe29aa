"""Dimensions stored by buckets of their key, so that a load writes only the buckets it changes.

The table's notes hold what a load would otherwise have to read it for: the newest ``updated_date``, and for each
bucket the number of rows and the XOR of their hashes. The latter tell which buckets differ from a source
without reading the table, also where a source row was edited and kept its date.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattfold.operators import dimensions
from wattfold.operators.dimensions import Dimension
from wattfold.settings import scratch_dir
from wattfold.sinks import snapshots

# Buckets of a table that is made anew; a table keeps the number it was made with.
BUCKETS = 64
BUCKET = "bucket"


class Loaded(NamedTuple):
    """What a load did: rows it took, source rows without a key, and buckets that it wrote."""

    rows: int
    null_keys: int
    buckets: int


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _row_hash(dimension: Dimension) -> Column:
    # Nulls are hashed by their place too, or a value could move to the next column unseen.
    marks = [F.coalesce(F.col(name).cast("string"), F.lit("\0")) for name in dimension.columns]
    return F.xxhash64(*marks, *[F.col(name).isNull() for name in dimension.columns])


def digests(rows: DataFrame, dimension: Dimension) -> DataFrame:
    """``bucket, rows, digest``: count and XOR of row hashes per bucket; does not depend on the order of rows."""
    return rows.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(_row_hash(dimension)).alias("digest")
    )


def _stored(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    folder = scratch_dir(spark, label)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _loaded_to(notes: dict[str, object]) -> date:
    return date.fromisoformat(notes["loaded_to"]) if notes.get("loaded_to") else dimensions.EARLIEST


def _put(spark: SparkSession, fresh: DataFrame, table: str, dimension: Dimension, buckets: int) -> int:
    """Rows with their bucket in place of those of the same key; how many buckets were written."""
    before = snapshots.current(spark, table)
    touched = sorted(row[BUCKET] for row in fresh.select(BUCKET).distinct().collect())
    if not touched and before.version >= 0:
        return 0
    merged = fresh
    names = [f"{BUCKET}={at}" for at in touched]
    if any(name in before.slices for name in names):
        target = snapshots.read(spark, table, names, before)
        kept = target.join(fresh.select(dimension.key), dimension.key, "left_anti")
        merged = kept.select(*fresh.columns).unionByName(fresh)
    merged = _stored(spark, merged, "dimension-buckets")
    newest = merged.agg(F.max("updated_date")).first()[0]
    newest = max(filter(None, [newest, _loaded_to(before.notes)]))
    found = {str(row[BUCKET]): [row["rows"], row["digest"]] for row in digests(merged, dimension).collect()}
    notes = {
        "buckets": buckets,
        "loaded_to": newest.isoformat(),
        "digests": {**before.notes.get("digests", {}), **found},
    }
    snapshots.replace_parts(merged, table, BUCKET, touched, notes)
    return len(touched)


def upsert(
    spark: SparkSession, source: DataFrame, table: str, dimension: Dimension, today: date | None = None,
    buckets: int = BUCKETS,
) -> Loaded:
    """Load source rows newer than the newest one loaded, in place of those of their keys.

    Only buckets that have such rows are read and written; the date loaded to comes from the table's
    notes and reaches the source's scan as a filter. Rows without a date count as changed ``today`` if that
    is given. One load of a table runs at a time.
    """
    notes = snapshots.current(spark, table).notes
    buckets = notes.get("buckets", buckets)
    if today is not None:
        source = dimensions.with_default_date(source, today)
    null_keys = Observation()
    rows = source.where(F.col("updated_date") > F.lit(_loaded_to(notes))).select(*dimension.columns)
    rows = rows.observe(null_keys, F.count_if(F.col(dimension.key).isNull()).alias("null_keys"))
    rows = dimensions.newest_per_key(rows.where(F.col(dimension.key).isNotNull()), dimension)
    # Stored, so that it is computed once and its size is known to the merge.
    fresh = _stored(spark, rows.withColumn(BUCKET, bucket_of(dimension.key, buckets)), "dimension-slice")
    taken = fresh.count()
    return Loaded(taken, null_keys.get["null_keys"], _put(spark, fresh, table, dimension, buckets))


def read(spark: SparkSession, table: str, dimension: Dimension) -> DataFrame:
    return snapshots.read(spark, table).select(*dimension.columns)


class Reconciled(NamedTuple):
    """Buckets that differ, and the keys in them that do: ``edited``, ``missing`` (in the table) or ``extra``."""

    buckets: tuple[int, ...]
    keys: DataFrame


def reconcile(spark: SparkSession, source: DataFrame, table: str, dimension: Dimension) -> Reconciled:
    """Where the table differs from its source, whatever the dates say.

    The source is read once for its digests, a row per bucket; the table is read only in buckets whose
    digests differ, and only there are rows compared. Of several source rows of a key the newest counts; rows
    without a key are left out.
    """
    before = snapshots.current(spark, table)
    buckets = before.notes["buckets"]
    rows = dimensions.newest_per_key(source.where(F.col(dimension.key).isNotNull()).select(*dimension.columns), dimension)
    rows = rows.withColumn(BUCKET, bucket_of(dimension.key, buckets))
    now = {str(row[BUCKET]): [row["rows"], row["digest"]] for row in digests(rows, dimension).collect()}
    known = before.notes.get("digests", {})
    differ = sorted(int(at) for at in now.keys() | known.keys() if now.get(at) != known.get(at))
    return Reconciled(tuple(differ), _compared(spark, rows, table, dimension, differ, before))


def _compared(
    spark: SparkSession, rows: DataFrame, table: str, dimension: Dimension, differ: Iterable[int], before: snapshots.Snapshot
) -> DataFrame:
    differ = list(differ)
    theirs = rows.where(F.col(BUCKET).isin(differ)).select(
        dimension.key, F.struct(*dimension.columns[1:]).alias("source_row")
    )
    ours = snapshots.read(spark, table, [f"{BUCKET}={at}" for at in differ], before)
    ours = ours.select(dimension.key, F.struct(*dimension.columns[1:]).alias("table_row"))
    kind = (
        F.when(F.col("table_row").isNull(), "missing")
        .when(F.col("source_row").isNull(), "extra")
        .when(~F.col("source_row").eqNullSafe(F.col("table_row")), "edited")
    )
    return theirs.join(ours, dimension.key, "full").select(dimension.key, kind.alias("kind")).where("kind IS NOT NULL")


def load_differences(spark: SparkSession, source: DataFrame, table: str, dimension: Dimension) -> Loaded:
    """Load the source's rows of all keys that differ, also of those with no newer date or none at all.

    Keys that the source no longer has stay, as in every load.
    """
    found = reconcile(spark, source, table, dimension)
    keys = found.keys.where("kind != 'extra'").select(dimension.key)
    rows = dimensions.newest_per_key(source.join(keys, dimension.key, "left_semi").select(*dimension.columns), dimension)
    buckets = snapshots.current(spark, table).notes["buckets"]
    fresh = _stored(spark, rows.withColumn(BUCKET, bucket_of(dimension.key, buckets)), "dimension-slice")
    return Loaded(fresh.count(), 0, _put(spark, fresh, table, dimension, buckets))
