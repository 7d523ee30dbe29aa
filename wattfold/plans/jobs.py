"""The pipeline's jobs, each one call over stored tables.

``warehouse`` is a folder that all executors share. It holds ``dim_date``, the versioned
dimensions and the two facts. Every job can be run again for the same day, month or version.
"""

from __future__ import annotations

from calendar import monthrange
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattfold import schemas
from wattfold.functions import payload
from wattfold.operators import calendar, checks, consumption, dimensions, places, revenue, rollups
from wattfold.plans import dimension_store, serving
from wattfold.sinks import files as sinks
from wattfold.sinks import snapshots
from wattfold.sources import files as sources
from wattfold.sources import queue, seeds
from wattfold.streaming import ingest

DIMENSIONS = {
    "dim_customer": dimensions.CUSTOMER,
    "dim_contract": dimensions.CONTRACT,
    "dim_electric_meter": dimensions.METER,
}


class Prices(NamedTuple):
    """The price tables of the operational store."""

    residential: DataFrame
    commercial: DataFrame
    industrial: DataFrame


class Landed(NamedTuple):
    """How many readings of a landing day went into the fact, how many were bad, how many of unknown meters."""

    billed: int
    bad: int
    unknown: int


def seed_prices(spark: SparkSession, operational: str) -> None:
    """The three seed price lists as tables of the operational store, in place of those there."""
    lists = Prices(seeds.residential_prices(spark), seeds.commercial_prices(spark), seeds.industrial_prices(spark))
    for name, prices in lists._asdict().items():
        prices.coalesce(1).write.mode("overwrite").parquet(f"{operational}/{name}_price")


def read_prices(spark: SparkSession, operational: str) -> Prices:
    return Prices(*[spark.read.parquet(f"{operational}/{name}_price") for name in Prices._fields])


def refuse_duplicates(rows: DataFrame, key: list[str], name: str) -> None:
    repeated = checks.duplicate_keys(rows, key).count()
    if repeated:
        raise ValueError(f"{name} has {repeated} keys that occur more than once")


def check_operational(customers: DataFrame, contracts: DataFrame, meters: DataFrame) -> dict[str, int]:
    """Refuse tables with repeated keys; otherwise how many references of each kind have no parent."""
    for rows, key, name in ((customers, "customer_id", "customer"), (contracts, "contract_id", "contract"),
                            (meters, "meter_id", "electric_meter")):
        refuse_duplicates(rows, [key], name)
    return {
        "contracts without a customer": checks.orphans(contracts, customers, "customer_id").count(),
        "meters without a contract": checks.orphans(meters, contracts, "contract_id").count(),
    }


def placed_meters(meters: DataFrame, known: DataFrame) -> tuple[DataFrame, int]:
    """Meters with the code and coordinates of their place, and how many place names are unknown."""
    bare = meters.drop("iso_code", "latitude", "longitude")
    return places.with_location(bare, known), places.unmatched_locations(meters, known).count()


def load_calendar(
    spark: SparkSession, warehouse: str, first: date = calendar.FIRST_DAY, last: date = calendar.LAST_DAY
) -> None:
    calendar.calendar(spark, first, last).coalesce(1).write.mode("overwrite").parquet(f"{warehouse}/dim_date")


def load_dimension(
    spark: SparkSession, source: DataFrame, warehouse: str, name: str, version: str, previous: str | None = None,
    today: date | None = None,
) -> int:
    """Write a dimension's next version and return how many source rows had no key.

    Without ``previous`` the dimension starts empty. Rows without a date count as changed ``today``;
    if no day is given, they are left for a run that gives one.
    """
    if today is not None:
        source = dimensions.with_default_date(source, today)
    dimension, base = DIMENSIONS[name], f"{warehouse}/{name}"
    if version == previous:
        raise ValueError(f"{name} cannot be read from and written to version {version} at once")
    if previous is None:
        target = source.select(*dimension.columns).where(F.lit(False))
    else:
        target = sinks.read_version(spark, base, previous)
    null_keys = Observation()
    # The slice is stored first: it is computed once, and its size is known to the merge.
    slices = f"{warehouse}/slices/{name}"
    sinks.write_version(dimensions.fresh_rows(source, target, dimension, null_keys=null_keys), slices, version)
    fresh = sinks.read_version(spark, slices, version)
    sinks.write_version(dimensions.merge(target, fresh, dimension), base, version)
    return null_keys.get["null_keys"]


def load_consumption(
    spark: SparkSession,
    landed: str,
    land_day: date,
    customers: DataFrame,
    contracts: DataFrame,
    meters: DataFrame,
    warehouse: str,
    measure_type: str = "double",
) -> Landed:
    """One landing day's files into the consumption fact.

    ``landed`` is the folder of the landing stream, or a glob over files from elsewhere with
    ``{day}`` where the landing day stands. The files of a landing day may hold readings of
    earlier days, so the fact keeps landing days apart and the roll-ups add them up.

    Every landed line is accounted for: bad ones are stored with their texts under ``bad_readings``,
    meters that nobody owns under ``unknown_meters``. Tables with repeated keys are refused.

    With a decimal ``measure_type`` sums are exact and do not depend on the order of rows; measures are
    rounded to its scale, and those beyond its range are bad lines. A warehouse keeps to one type.
    """
    check_operational(customers, contracts, meters)
    stamp = land_day.strftime("%Y%m%d")
    if "{day}" in landed:
        texts = sources.read_reading_texts(spark, landed.replace("{day}", stamp))
    else:
        texts = sources.read_landed_texts(spark, landed, land_day)
    names = schemas.READING_COLUMNS
    kept = texts.select(*payload.decode_fields(*[F.col(name) for name in names], measure_type), F.struct(*names).alias("text"))
    bad, days, strange = (f"{warehouse}/{name}" for name in ("bad_readings", "meter_days", "unknown_meters"))
    sinks.write_version(kept.where(~payload.is_valid()).select("text.*"), bad, stamp)
    # Stored, so that its sums are made once for the fact and the counts.
    sinks.write_version(consumption.meter_days(kept.where(payload.is_valid())), days, stamp)
    per_meter = sinks.read_version(spark, days, stamp)
    # Stored, so that its size is known to the join with the readings.
    bridges = f"{warehouse}/customer_meter"
    sinks.write_version(consumption.customer_meter_bridge(customers, contracts, meters), bridges, stamp)
    bridge = sinks.read_version(spark, bridges, stamp)
    fact = consumption.owned_consumption(per_meter, bridge)
    snapshots.replace_slice(fact, f"{warehouse}/fact_power_consumption", "land_day", stamp, "date_id")
    sinks.write_version(consumption.unknown_meters(per_meter, bridge), strange, stamp)
    readings = F.coalesce(F.sum("readings"), F.lit(0))
    unknown = sinks.read_version(spark, strange, stamp).agg(readings).first()[0]
    return Landed(per_meter.agg(readings).first()[0] - unknown, sinks.read_version(spark, bad, stamp).count(), unknown)


def load_revenue(spark: SparkSession, warehouse: str, year: int, month: int, version: str, prices: Prices) -> None:
    """The bills of all segments for one month, with the given version of the dimensions.

    Refused before anything is written if the stored calendar lacks a day of the month, since bills
    and roll-ups would lose that day's readings.
    """
    days = spark.read.parquet(f"{warehouse}/dim_date")
    month_id = year * 100 + month
    there = days.where(F.floor(F.col("date_id") / 100) == month_id).select("date_id").distinct().count()
    if there != monthrange(year, month)[1]:
        raise ValueError(f"dim_date covers {there} days of {year}-{month:02d}; load a calendar that has them all")
    business = revenue.business_prices(prices.commercial, prices.industrial)
    refuse_duplicates(business, ["customer_type", "voltage_tier", "time_of_day"], "the price list")
    bills = revenue.all_revenue(
        snapshots.read(spark, f"{warehouse}/fact_power_consumption"),
        days,
        sinks.read_version(spark, f"{warehouse}/dim_customer", version),
        sinks.read_version(spark, f"{warehouse}/dim_electric_meter", version),
        prices.residential,
        business,
        year,
        month,
    )
    date_id = year * 10000 + month * 100 + 1
    snapshots.replace_slice(bills, f"{warehouse}/fact_revenue", "date_id", date_id, "customer_type")


def _star(spark: SparkSession, warehouse: str, version: str) -> tuple[DataFrame, ...]:
    return (
        snapshots.read(spark, f"{warehouse}/fact_power_consumption"),
        snapshots.read(spark, f"{warehouse}/fact_revenue").drop("customer_type"),
        spark.read.parquet(f"{warehouse}/dim_date"),
        sinks.read_version(spark, f"{warehouse}/dim_customer", version),
        sinks.read_version(spark, f"{warehouse}/dim_electric_meter", version),
    )


def serve_views(spark: SparkSession, warehouse: str, version: str) -> list[str]:
    """Register the nine roll-ups over the stored star schema, for this session."""
    return rollups.register_views(*_star(spark, warehouse, version))


def store_views(spark: SparkSession, warehouse: str, version: str) -> dict[str, set[str]]:
    """Bring the nine roll-ups stored under ``views`` up to the facts, for readers outside this session.

    Only days and months that were loaded since are written; returns which, by roll-up.
    """
    return serving.refresh_views(spark, warehouse, version)


def upsert_dimension(
    spark: SparkSession, source: DataFrame, warehouse: str, name: str, today: date | None = None
) -> dimension_store.Loaded:
    """Load a dimension in place: only buckets of keys that have newer source rows are written."""
    return dimension_store.upsert(spark, source, f"{warehouse}/current/{name}", DIMENSIONS[name], today)


def reconcile_dimension(
    spark: SparkSession, source: DataFrame, warehouse: str, name: str, load: bool = False
) -> dict[str, int]:
    """How many keys of a dimension differ from the source, by kind, whatever their dates say; loaded if asked for."""
    table = f"{warehouse}/current/{name}"
    found = dimension_store.reconcile(spark, source, table, DIMENSIONS[name])
    kinds = {row["kind"]: row["count"] for row in found.keys.groupBy("kind").count().collect()}
    if load and kinds:
        dimension_store.load_differences(spark, source, table, DIMENSIONS[name])
    return kinds


def tidy(spark: SparkSession, table: str, days: float = 7) -> int:
    """Remove what no reader of a table needs any more: folders that were replaced or never published."""
    return snapshots.vacuum(spark, table, days * 24 * 3600)


def export_readings(spark: SparkSession, path_glob: str, out: str, per: str = "hour") -> None:
    """Landed readings as one CSV folder per hour or day; readings without a moment have a folder too."""
    sinks.write_readings_csv(sources.read_readings(spark, path_glob), out, per)


def publish_readings(spark: SparkSession, path_glob: str, servers: str, topic: str) -> None:
    """Landed readings into a queue, one message each."""
    queue.publish(sources.read_readings(spark, path_glob), servers, topic)


def start_landing(
    messages: DataFrame, folder: str, checkpoint: str, interval: str | None = "1 hour", delay: str | None = "1 day",
    zone: str | None = None,
) -> StreamingQuery:
    """Messages into CSV files by day of arrival in ``zone``, for the daily job to pick up.

    Repeats are dropped by the rule of the speed layer, so both layers hold the same readings.
    """
    if delay is not None:
        parsed = ingest.parse_messages(messages.withColumn("line", F.col("value")))
        messages = ingest.drop_repeats(parsed, delay).withColumnRenamed("line", "value")
    return ingest.land_csv(messages, folder, checkpoint, interval, zone)


def start_speed_layer(
    messages: DataFrame, table: str, checkpoint: str, interval: str | None = "10 seconds", delay: str | None = "1 day"
) -> StreamingQuery:
    """Messages into the speed-layer table. Repeats are dropped unless ``delay`` is None: those within it by what
    the stream remembers, later ones by a look at the days they were measured."""
    parsed = ingest.parse_messages(messages)
    if delay is not None:
        parsed = ingest.drop_repeats(parsed, delay)
    return ingest.ingest(parsed, table, checkpoint, interval, delay=delay)
