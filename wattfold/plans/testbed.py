"""The benchmark tables seen as metering tables.

Meters and customers come from ``customer``; readings from ``events`` (every hour of one
month) and ``lineitem`` (seven years); change histories from ``orders`` and ``lineitem``.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.functions import segments
from wattfold.functions.payload import encode_reading
from wattfold.settings import bounded_session, scratch_dir
from wattfold.operators import calendar as calendar_ops
from wattfold.operators import consumption, places
from wattfold.sources import files

CALENDAR = (date(1995, 1, 1), date(2024, 12, 31))
CUSTOMERS_LOADED_TO = date(2001, 1, 1)
CONTRACTS_LOADED_TO = date(1998, 1, 1)
METERS_LOADED_TO = date(2001, 7, 1)
INSERT_DAY = date(2024, 2, 1)

# Columns that the queries use; declared, so that no job has to read file footers first.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ, "
    "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_discount DOUBLE, "
    "l_shipdate TIMESTAMP_NTZ",
}

# Sums of up to eight digits are kept as plain longs; readings are far below 1,000,000 kWh.
MEASURE = "decimal(8,2)"


class Testbed:
    """Domain tables over one folder of benchmark tables; each is built when asked for."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def bounded(self) -> Testbed:
        """These tables in a session whose tasks have a bound, however many readings there are."""
        rows = self.table("events").count() + self.table("lineitem").count()
        return Testbed(bounded_session(self.spark, rows), self.folder)

    def table(self, name: str) -> DataFrame:
        return files.read_table(self.spark, self.folder, name, SCHEMAS[name])

    def stored(self, rows: DataFrame, label: str) -> DataFrame:
        """The rows as a table, so that their size is known to a join."""
        folder = scratch_dir(self.spark, label)
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def event_span(self) -> tuple[datetime, datetime]:
        """The first and last hour of the months that the events are in; without events, any hour."""
        at = F.col("ts")
        last = F.expr("date_trunc('month', max(ts)) + INTERVAL 1 MONTH - INTERVAL 1 HOUR").cast("timestamp_ntz")
        first = F.date_trunc("month", F.min(at)).cast("timestamp_ntz")
        span = self.table("events").agg(first.alias("first"), last.alias("last")).first()
        return (span.first, span.last) if span.first is not None else (datetime(2000, 1, 1),) * 2

    def event_readings(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("meter_id"),
            F.col("value").cast(MEASURE).alias("measure"),
            F.col("ts").alias("datetime_measured"),
        )

    def bulk_readings(self) -> DataFrame:
        hour = F.expr("make_dt_interval(0, l_linenumber * 4 - 1)")
        return self.table("lineitem").select(
            F.col("l_partkey").alias("meter_id"),
            (F.col("l_quantity") * F.col("l_linenumber")).cast(MEASURE).alias("measure"),
            (F.col("l_shipdate") + hour).alias("datetime_measured"),
        )

    def readings(self) -> DataFrame:
        return self.event_readings().unionByName(self.bulk_readings())

    def messages(self) -> DataFrame:
        """A stream of queue messages, one per event.

        The path is a glob because a file stream takes a lone file only that way.
        """
        path = f"{self.folder}/events.parque[t]"
        events = self.spark.readStream.schema(SCHEMAS["events"]).parquet(path)
        line = encode_reading(F.col("user_id"), F.col("value"), F.col("ts"))
        return events.select(line.cast("binary").alias("value"), F.col("ts").alias("timestamp"))

    def customers(self) -> DataFrame:
        market = F.col("c_mktsegment")
        segment = (
            F.when(market.isin("HOUSEHOLD", "FURNITURE"), segments.RESIDENTIAL)
            .when(market.isin("BUILDING", "AUTOMOBILE"), segments.COMMERCIAL)
            .otherwise(segments.INDUSTRIAL)
        )
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat_ws("-", "c_nationkey", "c_custkey").alias("phone"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("Main street "), F.col("c_nationkey").cast("string")).alias("address"),
            segment.alias("customer_type"),
        )

    def contracts(self) -> DataFrame:
        customer = F.col("c_custkey")
        return self.table("customer").select((customer + 1000000).alias("contract_id"), customer.alias("customer_id"))

    def places(self) -> DataFrame:
        """Place codes; the nations of the last region are left out, so some meters find none."""
        nation = F.col("n_nationkey")
        return self.table("nation").where(F.col("n_regionkey") < 4).select(
            F.col("n_name").alias("location"),
            F.concat(F.lit("XX-"), nation.cast("string")).alias("iso_code"),
            (nation * 1.5).cast("double").alias("latitude"),
            (nation * -2.5).cast("double").alias("longitude"),
        )

    def installed_meters(self) -> DataFrame:
        """Meters with their contract; three neighbouring customer numbers share one owner."""
        contract = F.expr("c_custkey div 3 + 1000000").alias("contract_id")
        return self.table("customer").select(F.col("c_custkey").alias("meter_id"), contract, "c_nationkey")

    def placed_meters(self) -> DataFrame:
        """Meters with their contract, owner segment, voltage and location name."""
        owners = self.contracts().join(self.customers().select("customer_id", "customer_type"), "customer_id")
        meter = F.col("meter_id")
        commercial = F.when(meter % 3 == 0, "less than 6kV").when(meter % 3 == 1, "6kV to less than 22kV")
        industrial = (
            F.when(meter % 4 == 0, "less than 6kV")
            .when(meter % 4 == 1, "6kV to less than 22kV")
            .when(meter % 4 == 2, "22kV to less than 100kV")
        )
        segment = F.col("customer_type")
        voltage = F.when(segment == segments.COMMERCIAL, commercial.otherwise("22kV and above")).when(
            segment == segments.INDUSTRIAL, industrial.otherwise("100kV and above")
        )
        nations = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("location"))
        return (
            self.installed_meters().join(owners, "contract_id")
            .join(nations, "c_nationkey")
            .select("meter_id", "contract_id", "customer_type", "location", voltage.alias("voltage"))
        )

    def meters(self) -> DataFrame:
        located = places.with_location(self.placed_meters(), self.places())
        kind = F.when(F.col("customer_type") == segments.RESIDENTIAL, "single-phase").otherwise("three-phase")
        return located.select(
            "meter_id",
            "contract_id",
            kind.alias("meter_type"),
            "voltage",
            F.lit("active").alias("status"),
            "location",
            "latitude",
            "longitude",
            "iso_code",
        )

    def meter_segments(self) -> DataFrame:
        return self.placed_meters().select("meter_id", "customer_type")

    def bridge(self) -> DataFrame:
        return consumption.customer_meter_bridge(self.customers(), self.contracts(), self.installed_meters())

    def dim_date(self) -> DataFrame:
        return calendar_ops.calendar(self.spark, *CALENDAR)

    def consumption(self) -> DataFrame:
        return consumption.daily_consumption(self.readings(), self.bridge())

    # Sources and loaded dimensions of the three incremental loads.

    def customer_source(self) -> DataFrame:
        """Customers, last changed on the day of their last pending order; some have none, so no date."""
        pending = self.table("orders").where(F.col("o_orderstatus") == "P")
        changed = pending.groupBy(F.col("o_custkey").alias("customer_id"))
        last = changed.agg(F.max(F.col("o_orderdate").cast("date")).alias("updated_date"))
        return self.customers().join(last, "customer_id", "left")

    def customer_target(self) -> DataFrame:
        """What had been loaded of customers with an urgent order: stale names and addresses."""
        urgent = self.table("orders").where(
            (F.col("o_orderpriority") == "1-URGENT")
            & (F.col("o_orderdate") < F.lit(CUSTOMERS_LOADED_TO).cast("timestamp_ntz"))
        )
        loaded = urgent.groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.max(F.col("o_orderdate").cast("date")).alias("updated_date")
        )
        stale = {"customer_name": F.upper("customer_name"), "address": F.lit("unknown")}
        return self.customers().withColumns(stale).join(loaded, "customer_id")

    def contract_source(self) -> DataFrame:
        """Orders as contracts, last changed when their last line shipped."""
        shipped = self.table("lineitem").groupBy(F.col("l_orderkey").alias("contract_id"))
        last = shipped.agg(F.max(F.col("l_shipdate").cast("date")).alias("updated_date"))
        return self._orders().join(last, "contract_id", "left")

    def contract_target(self) -> DataFrame:
        loaded = self._orders().where(F.col("date_created") < F.lit(CONTRACTS_LOADED_TO))
        return loaded.withColumns({"status": F.lit("X"), "updated_date": F.col("date_created")})

    def _orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("contract_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("date_created"),
            F.col("o_orderstatus").alias("status"),
        )

    def meter_source(self) -> DataFrame:
        """Meters, last changed on the day of their last reading."""
        read = self.readings().groupBy("meter_id")
        last = read.agg(F.max(F.col("datetime_measured").cast("date")).alias("updated_date"))
        return self.meters().join(last, "meter_id", "left")

    def meter_target(self) -> DataFrame:
        """Meters that had shipped a line without discount by the load day, at an unknown place."""
        undiscounted = self.table("lineitem").where(
            (F.col("l_discount") == 0) & (F.col("l_shipdate") < F.lit(METERS_LOADED_TO).cast("timestamp_ntz"))
        )
        loaded = undiscounted.groupBy(F.col("l_partkey").alias("meter_id")).agg(
            F.max(F.col("l_shipdate").cast("date")).alias("updated_date")
        )
        stale = {"status": F.lit("installed"), "location": F.lit("unknown")}
        return self.meters().withColumns(stale).join(loaded, "meter_id")


def as_double(rows: DataFrame, *columns: str) -> DataFrame:
    """Exact decimal sums as the doubles that the star schema stores."""
    return rows.withColumns({name: F.col(name).cast("double") for name in columns})
