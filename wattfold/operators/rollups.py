"""Serving roll-ups over the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = ("day", "month", "year")
MONTH = ("month", "year")


class Lookup(NamedTuple):
    """A dimension, its key in the fact, and the columns a roll-up groups by."""

    dim: DataFrame
    key: str
    attributes: Sequence[str]


def star_rollup(
    fact: DataFrame,
    dim_date: DataFrame,
    period: Sequence[str],
    measure: str,
    lookups: Sequence[Lookup] = (),
    fact_columns: Sequence[str] = (),
) -> DataFrame:
    """Sum a measure by period, dimension attributes and fact columns.

    The fact is first summed by its foreign keys and the period. A customer or meter that
    holds a third of the fact is then down to a few rows per period before any join, and
    the joins carry far fewer rows. Dimension keys are unique, so where the roll-up keeps
    them all, that sum is already the result; otherwise a second one follows the joins.
    """
    fact_keys = [lookup.key for lookup in lookups]
    kept = [*dict.fromkeys([*fact_keys, *fact_columns])]
    rolled = (
        fact.join(dim_date.select("date_id", *period), "date_id")
        .groupBy(*kept, *period)
        .agg(F.sum(measure).alias(measure))
    )
    grouping: list[str] = []
    for lookup in lookups:
        columns = [*dict.fromkeys([lookup.key, *lookup.attributes])]
        rolled = rolled.join(lookup.dim.select(*columns), lookup.key)
        grouping += lookup.attributes
    grouping += [*fact_columns, *period]
    if set(fact_keys) <= set(grouping):
        return rolled.select(*grouping, measure)
    return rolled.groupBy(*grouping).agg(F.sum(measure).alias(measure))


def daily_total_consumption(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return star_rollup(fact, dim_date, DAY, "consumption")


def daily_consumption_by_customer(fact: DataFrame, dim_date: DataFrame, customers: DataFrame) -> DataFrame:
    who = Lookup(customers, "customer_id", ["customer_id", "customer_name", "customer_type"])
    return star_rollup(fact, dim_date, DAY, "consumption", [who])


def daily_consumption_by_customer_type(fact: DataFrame, dim_date: DataFrame, customers: DataFrame) -> DataFrame:
    return star_rollup(fact, dim_date, DAY, "consumption", [Lookup(customers, "customer_id", ["customer_type"])])


def daily_consumption_by_location(fact: DataFrame, dim_date: DataFrame, meters: DataFrame) -> DataFrame:
    return star_rollup(fact, dim_date, DAY, "consumption", [Lookup(meters, "meter_id", ["location", "iso_code"])])


def _customer_and_meter(customers: DataFrame, meters: DataFrame) -> list[Lookup]:
    # The customer join comes first: it may be skewed (one owner of many meters), and the
    # exchange for the meter join behind it lets adaptive execution split it.
    return [
        Lookup(customers, "customer_id", ["customer_id", "customer_name"]),
        Lookup(meters, "meter_id", ["meter_id"]),
    ]


def daily_consumption_by_meter(
    fact: DataFrame, dim_date: DataFrame, customers: DataFrame, meters: DataFrame
) -> DataFrame:
    return star_rollup(fact, dim_date, DAY, "consumption", _customer_and_meter(customers, meters))


def daily_consumption_by_time_of_day(
    fact: DataFrame, dim_date: DataFrame, customers: DataFrame, meters: DataFrame
) -> DataFrame:
    lookups = _customer_and_meter(customers, meters)
    return star_rollup(fact, dim_date, DAY, "consumption", lookups, ["time_of_day"])


def monthly_total_revenue(revenue: DataFrame, dim_date: DataFrame) -> DataFrame:
    return star_rollup(revenue, dim_date, MONTH, "revenue")


def monthly_revenue_by_customer(revenue: DataFrame, dim_date: DataFrame, customers: DataFrame) -> DataFrame:
    who = Lookup(customers, "customer_id", ["customer_id", "customer_name", "customer_type"])
    return star_rollup(revenue, dim_date, MONTH, "revenue", [who])


def monthly_revenue_by_customer_type(revenue: DataFrame, dim_date: DataFrame, customers: DataFrame) -> DataFrame:
    return star_rollup(revenue, dim_date, MONTH, "revenue", [Lookup(customers, "customer_id", ["customer_type"])])


def all_rollups(
    consumption: DataFrame, revenue: DataFrame, dim_date: DataFrame, customers: DataFrame, meters: DataFrame
) -> dict[str, DataFrame]:
    """The nine roll-ups by name."""
    return {
        "daily_total_consumption": daily_total_consumption(consumption, dim_date),
        "daily_consumption_by_customer": daily_consumption_by_customer(consumption, dim_date, customers),
        "daily_consumption_by_customer_type": daily_consumption_by_customer_type(consumption, dim_date, customers),
        "daily_consumption_by_location": daily_consumption_by_location(consumption, dim_date, meters),
        "monthly_total_revenue": monthly_total_revenue(revenue, dim_date),
        "monthly_revenue_by_customer": monthly_revenue_by_customer(revenue, dim_date, customers),
        "monthly_revenue_by_customer_type": monthly_revenue_by_customer_type(revenue, dim_date, customers),
        "daily_consumption_by_meter": daily_consumption_by_meter(consumption, dim_date, customers, meters),
        "daily_consumption_by_time_of_day": daily_consumption_by_time_of_day(
            consumption, dim_date, customers, meters
        ),
    }


def register_views(
    consumption: DataFrame, revenue: DataFrame, dim_date: DataFrame, customers: DataFrame, meters: DataFrame
) -> list[str]:
    """Create or replace the nine roll-ups as temporary views; returns their names."""
    views = all_rollups(consumption, revenue, dim_date, customers, meters)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
