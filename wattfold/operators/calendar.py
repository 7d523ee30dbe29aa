"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.functions import keys

# The days the calendar covers unless told otherwise, both included.
FIRST_DAY = date(2023, 1, 1)
LAST_DAY = date(2025, 1, 1)


def _days(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    day = F.col("date")
    return bounds.select(F.explode(F.sequence(first, last)).alias("date")).select(
        keys.date_id(day).alias("date_id"),
        "date",
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
    )


def calendar(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    if last < first:
        raise ValueError(f"calendar ends on {last}, before it starts on {first}")
    bounds = spark.sql("SELECT * FROM VALUES (:first, :last) AS span(first, last)", {"first": first, "last": last})
    return _days(bounds, F.col("first"), F.col("last"))


def _within(day: Column, first: date | None, last: date | None) -> Column:
    held = F.lit(True) if first is None else day >= F.lit(first)
    return held if last is None else held & (day <= F.lit(last))


def calendar_spanning(rows: DataFrame, moment: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The calendar from the earliest to the latest day found in a column.

    Days before ``first`` or after ``last`` do not stretch it, so that one wrong date does not make
    millennia; ``outside`` counts their rows.
    """
    day = F.col(moment).cast("date")
    bounds = rows.where(_within(day, first, last)).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return _days(bounds, F.col("first"), F.col("last"))


def outside(rows: DataFrame, moment: str, first: date | None = None, last: date | None = None) -> int:
    """How many rows lie on a day that the bounds of ``calendar_spanning`` leave out."""
    return rows.where(~_within(F.col(moment).cast("date"), first, last)).count()
