"""Daily consumption to monthly bills.

Every job sums the fact per customer, contract, meter and month before it joins a
dimension, so joins and bills work on monthly rows instead of daily ones. Keys of the
dimensions are unique, so a dimension adds columns or drops rows but never repeats any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattfold import schemas
from wattfold.functions import keys, segments, tariff

ACCOUNT = ("customer_id", "contract_id", "meter_id")


def month_slice(fact: DataFrame, dim_date: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Fact rows whose day is in the calendar, with ``year`` and ``month``; one month if given.

    The month is also put as a range on ``date_id``, which prunes partitions of the fact.
    """
    if (year is None) != (month is None):
        raise ValueError("give both year and month, or neither")
    days = dim_date.select("date_id", "year", "month")
    if year is not None and month is not None:
        fact = fact.where(F.col("date_id").between(*keys.month_bounds(year, month)))
        days = days.where((F.col("year") == year) & (F.col("month") == month))
    return fact.join(days, "date_id")


def segment_month_filter(
    fact: DataFrame, dim_date: DataFrame, customers: DataFrame, segment: str, year: int, month: int
) -> DataFrame:
    """Daily fact rows of one segment in one month; the segment is case-sensitive."""
    return _of_segment(month_slice(fact, dim_date, year, month), customers, segment)


def _of_segment(rows: DataFrame, customers: DataFrame, segment: str) -> DataFrame:
    members = customers.where(F.col("customer_type") == segment).select("customer_id")
    return rows.join(members, "customer_id", "left_semi")


def _by_month(fact: DataFrame, dim_date: DataFrame, year: int | None, month: int | None, *extra: str) -> DataFrame:
    return (
        month_slice(fact, dim_date, year, month)
        .withColumn("date_id", keys.month_id(F.col("year"), F.col("month")))
        .groupBy(*ACCOUNT, "date_id", *extra)
        .agg(F.sum("consumption").alias("consumption"))
    )


def monthly_consumption(
    fact: DataFrame,
    dim_date: DataFrame,
    customers: DataFrame,
    segment: str,
    meters: DataFrame | None = None,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Monthly consumption of one segment; with ``meters`` also per band and voltage."""
    if meters is None:
        return _of_segment(_by_month(fact, dim_date, year, month), customers, segment)
    monthly = _of_segment(_by_month(fact, dim_date, year, month, "time_of_day"), customers, segment)
    return monthly.join(meters.select("meter_id", "voltage"), "meter_id")


def residential_revenue(monthly: DataFrame, prices: DataFrame, by_parts: bool = False) -> DataFrame:
    """Progressive bill per meter and month; ``by_parts`` picks the sum-over-slabs form."""
    charge = tariff.slab_charge_by_parts if by_parts else tariff.slab_charge
    bill = charge(F.col("consumption"), tariff.slab_rates(F.col("price_by_tier")))
    # The map is a column of its own so that the plan holds its subquery once.
    priced = monthly.withColumn("price_by_tier", tariff.price_by_tier(prices))
    return priced.withColumn("revenue", bill).select(*schemas.REVENUE_FACT)


def time_of_use_revenue(monthly: DataFrame, prices: DataFrame) -> DataFrame:
    """Bill per meter and month from band prices; a row without a price earns nothing."""
    priced = monthly.join(prices.withColumnRenamed("voltage_tier", "voltage"), ["voltage", "time_of_day"])
    return (
        priced.groupBy(*ACCOUNT, "date_id")
        .agg(F.sum(F.col("consumption") * F.col("price")).alias("revenue"))
        .select(*schemas.REVENUE_FACT)
    )


def business_prices(commercial: DataFrame, industrial: DataFrame) -> DataFrame:
    """Both band price lists as one, told apart by ``customer_type``."""
    lists = ((segments.COMMERCIAL, commercial), (segments.INDUSTRIAL, industrial))
    first, second = (
        prices.select(F.lit(segment).alias("customer_type"), "voltage_tier", "time_of_day", "price")
        for segment, prices in lists
    )
    return first.unionByName(second)


def all_revenue(
    fact: DataFrame,
    dim_date: DataFrame,
    customers: DataFrame,
    meters: DataFrame,
    residential_prices: DataFrame,
    band_prices: DataFrame,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """The bills of all three segments from one pass over the fact.

    ``band_prices`` holds the price lists of both business segments, told apart by
    ``customer_type``. The result has the rows that the three jobs would append in turn,
    plus ``customer_type`` for partitioning.
    """
    is_home: Column = F.col("customer_type") == segments.RESIDENTIAL
    payers = customers.where(F.col("customer_type").isin(*segments.SEGMENTS)).select("customer_id", "customer_type")
    monthly = _by_month(fact, dim_date, year, month, "time_of_day").join(payers, "customer_id")
    # Homes have no band price, so they neither need a voltage nor depend on the meter table.
    voltages = meters.where(F.col("voltage").isNotNull()).select(F.col("meter_id").alias("dim_meter_id"), "voltage")
    monthly = monthly.join(voltages, (F.col("meter_id") == F.col("dim_meter_id")) & ~is_home, "left")
    price_list = band_prices.withColumnRenamed("voltage_tier", "voltage")
    priced = monthly.join(price_list, ["customer_type", "voltage", "time_of_day"], "left")
    bill = tariff.slab_charge(F.col("consumption"), tariff.slab_rates(F.col("price_by_tier")))
    return (
        priced.where(is_home | F.col("price").isNotNull())
        .groupBy(*ACCOUNT, "date_id", "customer_type")
        .agg(
            F.sum("consumption").alias("consumption"),
            F.sum(F.col("consumption") * F.col("price")).alias("band_revenue"),
        )
        .withColumn("price_by_tier", tariff.price_by_tier(residential_prices))
        .withColumn("revenue", F.when(is_home, bill).otherwise(F.col("band_revenue")))
        .select(*schemas.REVENUE_FACT, "customer_type")
    )


def preview(revenue: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows by customer, with ties broken so that the report repeats."""
    return revenue.orderBy("customer_id", "contract_id", "meter_id", "date_id").limit(rows)
