"""Data checks: keys, orphans, readings out of range and missing readings."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfold.functions import keys, segments

# Bit of a day mask, above the 24 hours, that marks a meter we expect readings from.
KNOWN_METER = 1 << 24


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary key values that occur more than once, with their number."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique_violations(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of a unique constraint that repeat; rows with a NULL among them are exempt."""
    return duplicate_keys(rows.dropna(subset=list(columns)), columns)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Foreign key values without a parent and how many rows carry them; NULL is no reference.

    Counting first leaves one row per value, so a value that fills the table does no harm.
    """
    references = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return references.join(parent.select(key), key, "left_anti")


def with_load_factor(readings: DataFrame, meter_segments: DataFrame) -> DataFrame:
    """Readings with their meter's segment and the load factor of their hour."""
    factor = segments.load_factor(F.col("customer_type"), F.col("datetime_measured"))
    return readings.join(meter_segments, "meter_id").withColumn("load_factor", factor)


def out_of_range(readings: DataFrame, meter_segments: DataFrame) -> DataFrame:
    """Readings outside the range their segment is expected to keep at that hour."""
    low, high = segments.expected_reading(F.col("customer_type"))
    ranged = with_load_factor(readings, meter_segments).withColumns(
        {"low": low * F.col("load_factor"), "high": high * F.col("load_factor")}
    )
    return ranged.where(~F.col("measure").between(F.col("low"), F.col("high")))


def missing_hours(readings: DataFrame, meters: DataFrame, first: datetime, last: datetime) -> DataFrame:
    """Hours from ``first`` to ``last``, both included, in which a meter sent nothing.

    Each day of a meter is one 24-bit mask of the hours seen. Masks of readings and an empty
    mask for every expected meter and day meet in a single aggregate, so neither a grid of
    hours nor a join is needed, and only the gaps are ever written out.
    """
    if last < first:
        raise ValueError(f"the span ends at {last}, before it starts at {first}")
    moment = F.col("datetime_measured")
    start, end = keys.moment_literal(first), keys.moment_literal(last)
    in_span = (moment >= start) & (moment < keys.moment_literal(last + timedelta(hours=1)))
    seen = readings.where(in_span).select(
        "meter_id", moment.cast("date").alias("day"), F.expr("shiftleft(1, hour(datetime_measured))").alias("hours")
    )
    days = F.sequence(F.lit(first.date()), F.lit(last.date()))
    expected = meters.select("meter_id", F.explode(days).alias("day"), F.lit(KNOWN_METER).alias("hours"))
    masks = expected.unionByName(seen).groupBy("meter_id", "day").agg(F.bit_or("hours").alias("hours"))
    empty_hours = F.expr("filter(sequence(0, 23), h -> getbit(hours, h) = 0)")
    gap = F.expr("cast(day as timestamp_ntz) + make_dt_interval(0, hour_of_day)").alias("hour_missing")
    return (
        masks.where(F.col("hours") >= KNOWN_METER)
        .select("meter_id", "day", F.explode(empty_hours).alias("hour_of_day"))
        .select("meter_id", gap)
        .where(F.col("hour_missing").between(start, end))
    )
