"""Readings to the daily consumption fact.

Keys of the operational tables are taken to be unique, as the data model declares them;
``checks.duplicate_keys`` verifies it, and the jobs refuse tables that break it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfold import schemas
from wattfold.functions import keys


def with_reading_features(readings: DataFrame) -> DataFrame:
    """Readings plus ``date_id`` and ``time_of_day``."""
    moment = F.col("datetime_measured")
    return readings.withColumns({"date_id": keys.date_id(moment), "time_of_day": keys.time_of_day(moment)})


def customer_meter_bridge(customers: DataFrame, contracts: DataFrame, meters: DataFrame) -> DataFrame:
    """Which customer and contract each meter belongs to; one row per meter.

    One contract may own a third of all meters. Only the last join can be skewed by that;
    what follows it is an exchange or nothing, so adaptive execution is free to split it.
    """
    owners = contracts.select("contract_id", "customer_id").join(
        customers.select("customer_id"), "customer_id", "left_semi"
    )
    return meters.select("meter_id", "contract_id").join(owners, "contract_id").select(*schemas.BRIDGE_COLUMNS)


def meter_days(readings: DataFrame) -> DataFrame:
    """Consumption and number of readings per meter, day and band.

    Map-side sums take the weight off a hot meter. Nearly all readings pass this one exchange, so
    its rows are kept small: day and band are fixed-width there.
    """
    moment = F.col("datetime_measured")
    return (
        readings.select("meter_id", "measure", moment.cast("date").alias("day"), keys.band_code(moment).alias("band"))
        .groupBy("meter_id", "day", "band")
        .agg(F.sum("measure").alias("consumption"), F.count(F.lit(1)).alias("readings"))
    )


def unknown_meters(days: DataFrame, bridge: DataFrame) -> DataFrame:
    """Meters of ``meter_days`` that the bridge does not know, with the number of their readings."""
    strange = days.join(bridge.select("meter_id"), "meter_id", "left_anti")
    return strange.groupBy("meter_id").agg(F.sum("readings").alias("readings"))


def owned_consumption(days: DataFrame, bridge: DataFrame) -> DataFrame:
    """``meter_days`` under the meters' owners, with day and band in their final form."""
    return days.join(bridge, "meter_id").select(
        keys.date_id(F.col("day")).alias("date_id"),
        *schemas.BRIDGE_COLUMNS,
        keys.band_name(F.col("band")).alias("time_of_day"),
        "consumption",
    )


def daily_consumption(readings: DataFrame, bridge: DataFrame) -> DataFrame:
    """Consumption per customer, contract, meter, day and band; unknown meters fall out.

    A meter has one owner, so summing per meter, day and band before the join gives the same
    groups, and the join carries at most three rows per meter and day.
    """
    return owned_consumption(meter_days(readings), bridge)
