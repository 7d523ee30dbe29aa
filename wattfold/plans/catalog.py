"""The registered queries: each operator over the whole benchmark tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold import schemas
from wattfold.functions import keys, payload, segments
from wattfold.operators import calendar, checks, consumption, dimensions, places, revenue, rollups
from wattfold.plans import dimension_store, serving
from wattfold.plans.testbed import INSERT_DAY, Testbed, as_double
from wattfold.settings import scratch_dir
from wattfold.sinks import files as file_sinks
from wattfold.sinks import snapshots
from wattfold.sources import files as file_sources
from wattfold.sources import seeds
from wattfold.streaming import ingest, speed

# The zone that meters' clocks are taken to run in.
METER_ZONE = "Asia/Ho_Chi_Minh"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    """Register a query under the name of the function that builds it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Testbed(spark, folder))

    QUERIES[build.__name__] = run
    return build


def bounded_query(build: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    """Register a query over the daily consumption, whose tasks each sum, join and sum again."""

    @functools.wraps(build)
    def bounded(bed: Testbed) -> DataFrame:
        return build(bed.bounded())

    query(bounded)
    return build


# Readings and the consumption fact.


@bounded_query
def fact_power_consumption(bed: Testbed) -> DataFrame:
    return as_double(bed.consumption(), "consumption")


@query
def reading_features(bed: Testbed) -> DataFrame:
    return as_double(consumption.with_reading_features(bed.readings()), "measure")


@query
def customer_meter_bridge(bed: Testbed) -> DataFrame:
    return bed.bridge()


# Calendar and seeds.


@query
def dim_date(bed: Testbed) -> DataFrame:
    return calendar.calendar_spanning(bed.readings(), "datetime_measured")


@query
def price_tables(bed: Testbed) -> DataFrame:
    """Every price in force and the number of meters that pay it."""
    metered = bed.placed_meters().groupBy("customer_type", "voltage").agg(F.count(F.lit(1)).alias("meters"))
    business = metered.withColumnRenamed("voltage", "voltage_tier").join(
        seeds.business_prices(bed.spark), ["customer_type", "voltage_tier"]
    )
    homes = metered.where(F.col("voltage").isNull()).drop("voltage")
    tiers = seeds.residential_prices(bed.spark).select(
        F.lit(segments.RESIDENTIAL).alias("customer_type"),
        F.col("description").alias("voltage_tier"),
        F.col("tier").cast("string").alias("time_of_day"),
        "price",
    )
    return as_double(business.unionByName(homes.join(tiers, "customer_type")), "price")


@query
def month_key(bed: Testbed) -> DataFrame:
    day = F.col("o_orderdate")
    return bed.table("orders").select("o_orderkey", keys.month_id(F.year(day), F.month(day)).alias("date_id"))


@bounded_query
def segment_month_filter(bed: Testbed) -> DataFrame:
    rows = revenue.segment_month_filter(
        bed.consumption(), bed.dim_date(), bed.customers(), segments.COMMERCIAL, 2024, 1
    )
    return as_double(rows, "consumption")


# Roll-ups of consumption.


@bounded_query
def view_daily_total_consumption(bed: Testbed) -> DataFrame:
    return as_double(rollups.daily_total_consumption(bed.consumption(), bed.dim_date()), "consumption")


@bounded_query
def view_daily_consumption_by_customer(bed: Testbed) -> DataFrame:
    rows = rollups.daily_consumption_by_customer(bed.consumption(), bed.dim_date(), bed.customers())
    return as_double(rows, "consumption")


@bounded_query
def view_daily_consumption_by_customer_type(bed: Testbed) -> DataFrame:
    rows = rollups.daily_consumption_by_customer_type(bed.consumption(), bed.dim_date(), bed.customers())
    return as_double(rows, "consumption")


@bounded_query
def view_daily_consumption_by_location(bed: Testbed) -> DataFrame:
    rows = rollups.daily_consumption_by_location(bed.consumption(), bed.dim_date(), bed.meters())
    return as_double(rows, "consumption")


@bounded_query
def view_daily_consumption_by_meter(bed: Testbed) -> DataFrame:
    rows = rollups.daily_consumption_by_meter(bed.consumption(), bed.dim_date(), bed.customers(), bed.meters())
    return as_double(rows, "consumption")


@bounded_query
def view_daily_consumption_by_time_of_day(bed: Testbed) -> DataFrame:
    rows = rollups.daily_consumption_by_time_of_day(
        bed.consumption(), bed.dim_date(), bed.customers(), bed.meters()
    )
    return as_double(rows, "consumption")


# Monthly consumption and bills.


def _monthly(bed: Testbed, segment: str) -> DataFrame:
    meters = None if segment == segments.RESIDENTIAL else bed.placed_meters()
    return revenue.monthly_consumption(bed.consumption(), bed.dim_date(), bed.customers(), segment, meters)


@bounded_query
def monthly_consumption_residential(bed: Testbed) -> DataFrame:
    return as_double(_monthly(bed, segments.RESIDENTIAL), "consumption")


@bounded_query
def monthly_consumption_commercial(bed: Testbed) -> DataFrame:
    return as_double(_monthly(bed, segments.COMMERCIAL), "consumption")


@bounded_query
def monthly_consumption_industrial(bed: Testbed) -> DataFrame:
    return as_double(_monthly(bed, segments.INDUSTRIAL), "consumption")


def _residential(bed: Testbed, by_parts: bool = False) -> DataFrame:
    monthly = _monthly(bed, segments.RESIDENTIAL)
    return revenue.residential_revenue(monthly, seeds.residential_prices(bed.spark), by_parts)


@bounded_query
def revenue_residential(bed: Testbed) -> DataFrame:
    return as_double(_residential(bed), "revenue")


@bounded_query
def revenue_residential_slab(bed: Testbed) -> DataFrame:
    return as_double(_residential(bed, by_parts=True), "revenue")


@bounded_query
def revenue_commercial(bed: Testbed) -> DataFrame:
    prices = seeds.commercial_prices(bed.spark)
    return as_double(revenue.time_of_use_revenue(_monthly(bed, segments.COMMERCIAL), prices), "revenue")


@bounded_query
def revenue_industrial(bed: Testbed) -> DataFrame:
    prices = seeds.industrial_prices(bed.spark)
    return as_double(revenue.time_of_use_revenue(_monthly(bed, segments.INDUSTRIAL), prices), "revenue")


def _revenue(bed: Testbed) -> DataFrame:
    return revenue.all_revenue(
        bed.consumption(),
        bed.dim_date(),
        bed.customers(),
        bed.placed_meters(),
        seeds.residential_prices(bed.spark),
        seeds.business_prices(bed.spark),
    )


@bounded_query
def fact_revenue(bed: Testbed) -> DataFrame:
    return as_double(_revenue(bed).select(*schemas.REVENUE_FACT), "revenue")


@bounded_query
def view_monthly_total_revenue(bed: Testbed) -> DataFrame:
    return as_double(rollups.monthly_total_revenue(_revenue(bed), bed.dim_date()), "revenue")


@bounded_query
def view_monthly_revenue_by_customer(bed: Testbed) -> DataFrame:
    rows = rollups.monthly_revenue_by_customer(_revenue(bed), bed.dim_date(), bed.customers())
    return as_double(rows, "revenue")


@bounded_query
def view_monthly_revenue_by_customer_type(bed: Testbed) -> DataFrame:
    rows = rollups.monthly_revenue_by_customer_type(_revenue(bed), bed.dim_date(), bed.customers())
    return as_double(rows, "revenue")


@bounded_query
def preview_revenue_top20(bed: Testbed) -> DataFrame:
    return as_double(revenue.preview(_residential(bed)), "revenue")


# Dimension upkeep.


@query
def incremental_watermark(bed: Testbed) -> DataFrame:
    return dimensions.watermark(bed.contract_target())


@query
def incremental_slice(bed: Testbed) -> DataFrame:
    return dimensions.incremental_slice(bed.contract_source(), bed.contract_target(), dimensions.CONTRACT)


def _fresh_customers(bed: Testbed) -> DataFrame:
    return dimensions.incremental_slice(bed.customer_source(), bed.customer_target(), dimensions.CUSTOMER)


@query
def upsert_changed_keys(bed: Testbed) -> DataFrame:
    return dimensions.changed_keys(_fresh_customers(bed), bed.customer_target(), dimensions.CUSTOMER)


@query
def upsert_new_keys(bed: Testbed) -> DataFrame:
    return dimensions.new_keys(_fresh_customers(bed), bed.customer_target(), dimensions.CUSTOMER)


@query
def upsert_dim_customer(bed: Testbed) -> DataFrame:
    return dimensions.upsert(bed.customer_source(), bed.customer_target(), dimensions.CUSTOMER)


@query
def upsert_dim_contract(bed: Testbed) -> DataFrame:
    return dimensions.upsert(bed.contract_source(), bed.contract_target(), dimensions.CONTRACT)


@query
def upsert_dim_meter(bed: Testbed) -> DataFrame:
    return dimensions.upsert(bed.meter_source(), bed.meter_target(), dimensions.METER)


@query
def default_updated_date(bed: Testbed) -> DataFrame:
    return dimensions.with_default_date(bed.customer_source(), INSERT_DAY)


@query
def meter_expand(bed: Testbed) -> DataFrame:
    contract = F.col("contract_id")
    contracts = bed.table("orders").select((F.col("o_orderkey") + 1).alias("contract_id"))
    is_home = segments.segment_of_contract(contract) == segments.RESIDENTIAL
    meter_count = F.when(is_home, F.lit(1)).otherwise((contract % 5 + 1).cast("int"))
    return dimensions.meters_for_contracts(contracts, meter_count)


@query
def contract_from_customer(bed: Testbed) -> DataFrame:
    return dimensions.contracts_for_customers(bed.customers())


# Checks and enrichment.


@bounded_query
def check_pk_duplicates(bed: Testbed) -> DataFrame:
    return checks.duplicate_keys(bed.consumption(), ["date_id", *schemas.BRIDGE_COLUMNS])


@query
def check_fk_orphans(bed: Testbed) -> DataFrame:
    return checks.orphans(bed.readings(), bed.placed_meters(), "meter_id")


@query
def check_unique(bed: Testbed) -> DataFrame:
    return checks.unique_violations(bed.contract_source(), ["customer_id"])


@query
def location_code_enrich(bed: Testbed) -> DataFrame:
    return places.with_location(bed.placed_meters().select("meter_id", "location"), bed.places())


@query
def segment_by_contract_range(bed: Testbed) -> DataFrame:
    contract = F.col("o_orderkey")
    return bed.table("orders").select(
        contract.alias("contract_id"), segments.segment_of_contract(contract).alias("customer_type")
    )


@query
def load_factor(bed: Testbed) -> DataFrame:
    rows = checks.with_load_factor(bed.readings(), bed.stored(bed.meter_segments(), "meter-segments"))
    return as_double(rows, "measure", "load_factor")


@query
def load_band_check(bed: Testbed) -> DataFrame:
    rows = checks.out_of_range(bed.readings(), bed.stored(bed.meter_segments(), "meter-segments"))
    return as_double(rows, "measure", "load_factor", "low", "high")


@query
def reading_grid_gaps(bed: Testbed) -> DataFrame:
    readings = bed.event_readings()
    return checks.missing_hours(readings, readings.select("meter_id").distinct(), *bed.event_span())


# Text forms, files and streams.


@query
def encode_reading_payload(bed: Testbed) -> DataFrame:
    line = payload.encode_reading(F.col("user_id"), F.col("value"), F.col("ts"))
    return bed.table("events").select("event_id", line.alias("value"))


@query
def parse_reading_payload(bed: Testbed) -> DataFrame:
    """Lines of which some are damaged: 'error' events lose the id, 'signup' events the time."""
    line = payload.encode_reading(F.col("user_id"), F.col("value"), F.col("ts"))
    kind = F.col("event_type")
    damaged = F.when(kind == "error", F.concat(F.lit("bad"), line)).when(
        kind == "signup", F.substring_index(line, ",", 2)
    )
    messages = bed.table("events").select("event_id", damaged.otherwise(line).cast("binary").alias("value"))
    return ingest.parse_messages(messages)


@query
def hourly_csv_partitions(bed: Testbed) -> DataFrame:
    folder = scratch_dir(bed.spark, "hourly-csv")
    file_sinks.write_readings_csv(bed.event_readings(), folder, per="hour")
    return file_sources.read_readings(bed.spark, folder)


@query
def scan_readings_csv(bed: Testbed) -> DataFrame:
    folder = scratch_dir(bed.spark, "landed-csv")
    file_sinks.write_readings_csv(bed.event_readings(), folder, per="day")
    return file_sources.read_readings(bed.spark, f"{folder}/land_day=*")


@query
def stream_ingest_readings(bed: Testbed) -> DataFrame:
    folder = scratch_dir(bed.spark, "speed")
    parsed = ingest.parse_messages(bed.messages())
    ingest.ingest(parsed, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return ingest.read_speed_table(bed.spark, f"{folder}/table").where("valid").select(*schemas.READING_COLUMNS)


@query
def stream_dedup_readings(bed: Testbed) -> DataFrame:
    """Every message is sent twice; each reading arrives once."""
    folder = scratch_dir(bed.spark, "dedup")
    twice = bed.messages().withColumn("sent", F.explode(F.sequence(F.lit(1), F.lit(2))))
    parsed = ingest.drop_repeats(ingest.parse_messages(twice))
    ingest.ingest(parsed, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return ingest.read_speed_table(bed.spark, f"{folder}/table").where("valid").select(*schemas.READING_COLUMNS)


@query
def stream_land_csv(bed: Testbed) -> DataFrame:
    folder = scratch_dir(bed.spark, "landing")
    ingest.land_csv(bed.messages(), f"{folder}/files", f"{folder}/checkpoint").awaitTermination()
    return file_sources.read_readings(bed.spark, f"{folder}/files")


@query
def ingest_latency(bed: Testbed) -> DataFrame:
    """Delay from the instant in the message to the message's own time stamp, per day, on clocks of one zone."""
    folder = scratch_dir(bed.spark, "latency")
    messages = bed.messages().withColumn("timestamp", payload.instant(F.col("timestamp"), METER_ZONE))
    delays = ingest.ingest_delay(ingest.parse_messages(messages), F.col("timestamp"), METER_ZONE)
    ingest.count_delays(delays, f"{folder}/delays", f"{folder}/checkpoint").awaitTermination()
    return ingest.histogram_report(ingest.merge_histograms(snapshots.read(bed.spark, f"{folder}/delays")))


# Stored tables that are switched in one step.


def _landing_days(bed: Testbed) -> dict[str, DataFrame]:
    """The consumption of the events that each of three landing days brought; days of measurement are in several."""
    late = F.hour("datetime_measured") >= 20
    readings = bed.event_readings()
    bridge = bed.stored(bed.bridge(), "landing-bridge")
    parts = {"20240201": readings.where(~late), "20240202": readings.where(late & (F.col("meter_id") % 2 == 0)),
             "20240203": readings.where(late & (F.col("meter_id") % 2 == 1))}
    return {day: consumption.daily_consumption(part, bridge) for day, part in parts.items()}


def _published(bed: Testbed, table: str, days: dict[str, DataFrame]) -> None:
    for day, rows in days.items():
        snapshots.replace_slice(rows, table, "land_day", day, "date_id")


@query
def publish_fact_slices(bed: Testbed) -> DataFrame:
    """Landing days published one by one, one of them first with the wrong rows; the fact adds them up."""
    table = scratch_dir(bed.spark, "fact")
    days = _landing_days(bed)
    _published(bed, table, {"20240202": days["20240201"], **days})
    fact = snapshots.read(bed.spark, table)
    keys_of = ["date_id", *schemas.BRIDGE_COLUMNS, "time_of_day"]
    return as_double(fact.groupBy(*keys_of).agg(F.sum("consumption").alias("consumption")), "consumption")


def _refreshed(bed: Testbed, view: str) -> DataFrame:
    """A stored roll-up after a second landing day, and after a third one that came late."""
    fact, table = scratch_dir(bed.spark, "fact"), scratch_dir(bed.spark, view)
    days, customers, meters = bed.dim_date(), bed.customers(), bed.meters()
    for day, rows in _landing_days(bed).items():
        snapshots.replace_slice(rows, fact, "land_day", day, "date_id")
        serving.refresh(bed.spark, table, view, fact, days, customers, meters, "1")
    return as_double(snapshots.read(bed.spark, table).drop("date_id"), "consumption")


@query
def refresh_daily_consumption_by_customer_type(bed: Testbed) -> DataFrame:
    return _refreshed(bed, "daily_consumption_by_customer_type")


@query
def refresh_daily_consumption_by_location(bed: Testbed) -> DataFrame:
    return _refreshed(bed, "daily_consumption_by_location")


@query
def speed_table_compacted(bed: Testbed) -> DataFrame:
    """Readings of a table of ten batches, eight of them merged; one batch is sent again after its merge."""
    table = scratch_dir(bed.spark, "speed-batches")
    rows = bed.event_readings().withColumn("measure", F.col("measure").cast("double"))
    rows = rows.withColumns({"raw": F.lit(None).cast("string"), "valid": F.lit(True)})
    batches = bed.stored(rows.withColumn("part", F.pmod(F.xxhash64("meter_id"), F.lit(10))), "batches")
    for part in [*range(10), 3]:
        speed.append_batch(batches.where(F.col("part") == part).drop("part"), table, "run", part)
        speed.compact(bed.spark, table)
    return speed.read_speed_table(bed.spark, table).where("valid").select(*schemas.READING_COLUMNS)


@query
def stream_late_repeats(bed: Testbed) -> DataFrame:
    """Every message is sent again to a stream that remembers nothing; the table does."""
    folder = scratch_dir(bed.spark, "repeats")
    for run in ("first", "second"):
        parsed = ingest.drop_repeats(ingest.parse_messages(bed.messages()))
        ingest.ingest(parsed, f"{folder}/table", f"{folder}/{run}", delay="1 day").awaitTermination()
    return ingest.read_speed_table(bed.spark, f"{folder}/table").where("valid").select(*schemas.READING_COLUMNS)


def _bucketed(bed: Testbed, source: DataFrame, target: DataFrame, dimension: dimensions.Dimension) -> str:
    """A dimension by buckets, with the target loaded and then the source."""
    table = scratch_dir(bed.spark, "dimension")
    for rows in (target, source):
        dimension_store.upsert(bed.spark, rows, table, dimension)
    return table


@query
def upsert_buckets_customer(bed: Testbed) -> DataFrame:
    table = _bucketed(bed, bed.customer_source(), bed.customer_target(), dimensions.CUSTOMER)
    return dimension_store.read(bed.spark, table, dimensions.CUSTOMER)


@query
def upsert_buckets_meter(bed: Testbed) -> DataFrame:
    table = _bucketed(bed, bed.meter_source(), bed.meter_target(), dimensions.METER)
    return dimension_store.read(bed.spark, table, dimensions.METER)


@query
def reconcile_customers(bed: Testbed) -> DataFrame:
    """Customers whose source row differs from what loads by date have brought."""
    table = _bucketed(bed, bed.customer_source(), bed.customer_target(), dimensions.CUSTOMER)
    return dimension_store.reconcile(bed.spark, bed.customer_source(), table, dimensions.CUSTOMER).keys


@query
def load_silent_edits(bed: Testbed) -> DataFrame:
    """The dimension after its differences were loaded: equal to the source."""
    table = _bucketed(bed, bed.customer_source(), bed.customer_target(), dimensions.CUSTOMER)
    dimension_store.load_differences(bed.spark, bed.customer_source(), table, dimensions.CUSTOMER)
    return dimension_store.read(bed.spark, table, dimensions.CUSTOMER)
