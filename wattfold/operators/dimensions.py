"""Incremental upkeep of the customer, contract and meter dimensions."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wattfold.functions import segments

# The watermark of an empty dimension, and the terms of a new contract.
EARLIEST = date(1900, 1, 1)
CONTRACT_START = date(2023, 1, 2)
CONTRACT_STATUS = "active"


class Dimension(NamedTuple):
    """Key and overwritten columns of a dimension; ``updated_date`` comes with all of them."""

    key: str
    attributes: tuple[str, ...]

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.key, *self.attributes, "updated_date")


CUSTOMER = Dimension("customer_id", ("customer_name", "phone", "email", "address", "customer_type"))
CONTRACT = Dimension("contract_id", ("date_created", "status"))
METER = Dimension(
    "meter_id", ("meter_type", "voltage", "status", "location", "latitude", "longitude", "iso_code")
)


def watermark(target: DataFrame) -> DataFrame:
    """The newest ``updated_date`` already loaded, as one row."""
    return target.agg(F.coalesce(F.max("updated_date"), F.lit(EARLIEST)).alias("watermark"))


def incremental_slice(
    source: DataFrame, target: DataFrame, dimension: Dimension, inclusive: bool = False
) -> DataFrame:
    """Source rows newer than the watermark, in the layout of the dimension.

    The watermark is a scalar subquery, so it reaches the scan of the source as a pushed
    filter. ``inclusive`` also takes rows of the watermark day itself, for sources that add
    rows to a day already loaded.
    """
    loaded_to = watermark(target).scalar()
    day = F.col("updated_date")
    return source.where(day >= loaded_to if inclusive else day > loaded_to).select(*dimension.columns)


def newest_per_key(rows: DataFrame, dimension: Dimension) -> DataFrame:
    """One row per key, the newest; a plain aggregate, so repeats of a hot key merge map-side."""
    rest = [column for column in dimension.columns if column not in (dimension.key, "updated_date")]
    newest = F.max(F.struct("updated_date", *rest)).alias("newest")
    return rows.groupBy(dimension.key).agg(newest).select(dimension.key, "newest.*").select(*dimension.columns)


def changed_keys(fresh: DataFrame, target: DataFrame, dimension: Dimension) -> DataFrame:
    """Rows of the slice whose key the dimension already has."""
    return fresh.join(target.select(dimension.key), dimension.key, "left_semi").select(*dimension.columns)


def new_keys(fresh: DataFrame, target: DataFrame, dimension: Dimension) -> DataFrame:
    """Rows of the slice whose key the dimension has not seen."""
    return fresh.join(target.select(dimension.key), dimension.key, "left_anti").select(*dimension.columns)


def fresh_rows(
    source: DataFrame,
    target: DataFrame,
    dimension: Dimension,
    inclusive: bool = False,
    null_keys: Observation | None = None,
) -> DataFrame:
    """The slice to load: one row per key, the newest. Rows without a key are left out.

    ``null_keys`` receives the number of rows left out, as ``null_keys``.
    """
    fresh = incremental_slice(source, target, dimension, inclusive)
    if null_keys is not None:
        fresh = fresh.observe(null_keys, F.count_if(F.col(dimension.key).isNull()).alias("null_keys"))
    return newest_per_key(fresh.where(F.col(dimension.key).isNotNull()), dimension)


def merge(target: DataFrame, fresh: DataFrame, dimension: Dimension) -> DataFrame:
    """The target with fresh rows in place of those of the same key; nothing is deleted.

    When ``fresh`` is read from a table, Spark knows its size and broadcasts a small one, so
    that the target is not shuffled.
    """
    kept = target.select(*dimension.columns).join(fresh.select(dimension.key), dimension.key, "left_anti")
    return kept.select(*dimension.columns).unionByName(fresh.select(*dimension.columns))


def upsert(source: DataFrame, target: DataFrame, dimension: Dimension, inclusive: bool = False) -> DataFrame:
    """The dimension after the load: newer source rows overwrite or join the target rows."""
    return merge(target, fresh_rows(source, target, dimension, inclusive), dimension)


def with_default_date(rows: DataFrame, today: date) -> DataFrame:
    """``updated_date`` filled in where an insert left it out; the day is given so that runs repeat."""
    return rows.withColumn("updated_date", F.coalesce(F.col("updated_date"), F.lit(today)))


def contracts_for_customers(customers: DataFrame) -> DataFrame:
    """One contract per customer, under the customer's number."""
    return customers.select(
        F.col("customer_id").alias("contract_id"),
        "customer_id",
        F.lit(CONTRACT_START).alias("date_created"),
        F.lit(CONTRACT_STATUS).alias("status"),
    )


def meters_for_contracts(contracts: DataFrame, meter_count: Column) -> DataFrame:
    """``meter_count`` meters per contract, with ids that leave room for five.

    None for a count below one; a count above five raises, as ids would meet those of the next contract.
    """
    too_many = F.raise_error(F.lit("a contract has at most five meters")).cast("int")
    last = F.when(meter_count > 5, too_many).otherwise(meter_count.cast("int"))
    some = contracts.where(meter_count >= 1)
    numbered = some.select("contract_id", F.explode(F.sequence(F.lit(1), last)).alias("k"))
    contract = F.col("contract_id")
    return numbered.select(
        ((contract - 1) * 5 + F.col("k")).alias("meter_id"),
        "contract_id",
        segments.meter_type(contract).alias("meter_type"),
    )
