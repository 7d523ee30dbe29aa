"""The speed-layer table: a snapshot per batch, merged so that folders follow the data and not the batches.

A slice holds a range of batches of one run (a stream's checkpoint). A new batch is a slice of its own;
``FAN`` slices of a level become one of the next level in a single entry of the log, so a reader has every
reading once before, during and after. With n batches there are at most ``FAN`` slices per level and
log n levels, and each reading is written once per level. Slices of ``FULL`` bytes are merged no further.
Readings lie by the day they were measured, so a slice's parts say which days it has.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattfold import schemas
from wattfold.sinks import snapshots
from wattfold.sinks.snapshots import Slice, Snapshot

FAN, FULL = 8, 64 << 30
# The folder of a measured day, its name where there is none, and what makes two lines the same.
DAY, NO_DAY = "measured_day", "__HIVE_DEFAULT_PARTITION__"
LINE = (*schemas.READING_COLUMNS, "raw")


class Batches(NamedTuple):
    """The batches of a slice, first and last included, and how often they were merged."""

    run: str
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"{self.run}/{self.level}/{self.first}-{self.last}"


def _batches(name: str) -> Batches:
    run, level, span = name.rsplit("/", 2)
    first, last = span.split("-")
    return Batches(run, int(level), int(first), int(last))


def last_batch(snapshot: Snapshot, run: str) -> int:
    """The last batch of a run that the table has; -1 if none."""
    return max((found.last for found in map(_batches, snapshot.slices) if found.run == run), default=-1)


def append_batch(batch: DataFrame, table: str, run: str, batch_id: int, known_before: Column | None = None) -> bool:
    """Add a batch once: one that the table has, on its own or merged, is left as it is.

    Batches of a run come in order, as a stream's do, so those up to the last are there. Readings measured
    before ``known_before``, and bad lines, are looked up in the table and left out if they are there: repeats
    that come later than a stream remembers. Only the measured days of such readings are read, so what is
    remembered is the table itself and what is read follows the late readings, not the table.
    """
    spark = batch.sparkSession
    if batch_id <= last_batch(snapshots.current(spark, table), run):
        return False
    rows = batch.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint"), DAY: measured_day()})
    if known_before is None:
        made = _write(rows, table)
    else:
        rows = rows.persist()
        made = _write(_unknown(rows, table, known_before), table)
        rows.unpersist()
    schema = _schema()

    def change(before: Snapshot) -> tuple[dict[str, Slice], dict[str, object]] | None:
        if batch_id <= last_batch(before, run):
            return None
        return {**before.slices, Batches(run, 0, batch_id, batch_id).name: made}, {**before.notes, "schema": schema.jsonValue()}

    snapshots.publish(spark, table, change)
    return True


def measured_day() -> Column:
    """The day that a reading was measured, as the folder that it goes to; null for bad lines."""
    return F.date_format("datetime_measured", "yyyyMMdd").cast("int")


def _schema() -> StructType:
    return StructType.fromDDL(f"{schemas.SPEED_READING}, {DAY} INT")


def _write(rows: DataFrame, table: str) -> Slice:
    return snapshots.write_folder(rows.select(*_schema().names), table, DAY)


def _unknown(rows: DataFrame, table: str, known_before: Column) -> DataFrame:
    late = F.coalesce(F.col("datetime_measured") < known_before, F.lit(True))
    days = [row[0] for row in rows.where(late).select(DAY).distinct().collect()]
    spark = rows.sparkSession
    if not days or snapshots.current(spark, table).version < 0:
        return rows
    known = read_days(spark, table, days).select(*[F.col(name).alias(f"__{name}") for name in LINE])
    same = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in LINE]
    return rows.where(~late).unionByName(rows.where(late).join(known, same, "left_anti"))


def read_days(spark: SparkSession, table: str, days: Iterable[int | None]) -> DataFrame:
    """The readings measured on some days; nothing but their folders is listed or opened."""
    return snapshots.read(spark, table, parts=(DAY, {NO_DAY if day is None else str(day) for day in days}))


def _next_merge(snapshot: Snapshot, run: str | None) -> list[Batches]:
    """The oldest ``FAN`` slices of a run and level that has so many; none if no level has."""
    groups: dict[tuple[str, int], list[Batches]] = {}
    for name, part in snapshot.slices.items():
        found = _batches(name)
        if part.bytes < FULL and run in (None, found.run):
            groups.setdefault((found.run, found.level), []).append(found)
    for _, members in sorted(groups.items(), key=lambda item: item[0][1]):
        if len(members) >= FAN:
            return sorted(members, key=lambda found: found.first)[:FAN]
    return []


def compact(spark: SparkSession, table: str, run: str | None = None) -> int:
    """Merge slices while a level has enough of them; how many merges were made.

    Batches that come in meanwhile stay as they are: a merge takes out only what it read.
    """
    merges = 0
    while members := _next_merge(snapshot := snapshots.current(spark, table), run):
        names = [found.name for found in members]
        # Slices without rows have no files; merged they are a slice without rows.
        made = _write(snapshots.read(spark, table, names, snapshot), table)
        merged = Batches(members[0].run, members[0].level + 1, members[0].first, members[-1].last)

        def change(before: Snapshot) -> tuple[dict[str, Slice], dict[str, object]] | None:
            if not set(names) <= set(before.slices):
                return None  # another merge took some of them
            kept = {name: part for name, part in before.slices.items() if name not in names}
            return {**kept, merged.name: made}, before.notes

        snapshots.publish(spark, table, change)
        merges += 1
    return merges


def read_speed_table(spark: SparkSession, table: str) -> DataFrame:
    return snapshots.read(spark, table).drop(DAY)
