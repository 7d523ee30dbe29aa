"""The registered queries: agreement with DuckDB and the shape of their plans."""

import contextlib
import io
from datetime import date

import compare_oracle
import pytest
from pyspark.sql import functions as F
from rows import table

import __spark_entry__ as contract
from wattfold.operators import calendar, checks, consumption, dimensions, revenue, rollups
from wattfold.plans.catalog import QUERIES
from wattfold.plans.oracle import ORACLES
from wattfold.plans.testbed import Testbed
from wattfold.sinks import snapshots
from wattfold.sources import seeds

STREAMS = {name for name in QUERIES if name.startswith("stream_")} | {"ingest_latency"}
FILES = {"hourly_csv_partitions", "scan_readings_csv"}


@pytest.fixture(scope="module")
def duck(small):
    return compare_oracle.duck(small)


def plan(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert contract.queries().items() >= QUERIES.items() and contract.oracle_sql().items() >= ORACLES.items()


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, small, name):
    assert compare_oracle.difference(spark, duck, small, name) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS - FILES))
def test_no_cross_join_and_no_python_in_the_plan(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert node not in text
    assert "Window" not in text


def test_watermark_reaches_the_scan(spark, folder):
    schema = "contract_id bigint, date_created date, status string, updated_date date"
    day = date(2024, 1, 1)
    table(spark, schema, (1, day, "x", day)).write.parquet(f"{folder}/source")
    source = spark.read.parquet(f"{folder}/source")
    text = plan(dimensions.incremental_slice(source, table(spark, schema, (2, day, "x", day)), dimensions.CONTRACT))
    assert "GreaterThan(updated_date,ScalarSubquery" in text


def test_a_small_stored_slice_leaves_the_target_unshuffled(spark, folder):
    day = F.lit("2024-01-01").cast("date")
    rows = lambda n: spark.range(n).select(
        F.col("id").alias("contract_id"), day.alias("date_created"), F.lit("x").alias("status"), day.alias("updated_date")
    )
    rows(1000).write.parquet(f"{folder}/target")
    rows(10).write.parquet(f"{folder}/fresh")
    target, fresh = spark.read.parquet(f"{folder}/target"), spark.read.parquet(f"{folder}/fresh")
    text = plan(dimensions.merge(target, fresh, dimensions.CONTRACT))
    assert "BroadcastHashJoin LeftAnti" in text and "hashpartitioning" not in text


def test_a_month_prunes_the_partitions_of_the_fact(spark, folder, small):
    bed = Testbed(spark, small)
    january = consumption.daily_consumption(bed.event_readings(), bed.bridge())
    snapshots.replace_slice(january, f"{folder}/fact", "land_day", 20240201, "date_id")
    fact = snapshots.read(spark, f"{folder}/fact")
    month = revenue.monthly_consumption(fact, bed.dim_date(), bed.customers(), "residential", year=2024, month=1)
    filters = next(line for line in plan(month).splitlines() if "PartitionFilters" in line)
    assert "20240101" in filters and "20240131" in filters


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skewed(spark):
    """Sizes at which nothing is broadcast and a hot key counts as skewed."""
    before = {key: spark.conf.get(key) for key in SKEWED}
    for key, value in SKEWED.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


METERS = 300_000


def owned(spark, column):
    """Meters of which a third have owner 0."""
    meter = F.col("id")
    return spark.range(METERS).select(
        meter.alias("meter_id"), F.when(meter % 3 == 0, 0).otherwise(meter).alias(column)
    )


def test_a_contract_with_a_third_of_all_meters_is_split(spark, skewed):
    parties = spark.range(METERS).select(F.col("id").alias("contract_id"), (F.col("id") + 1).alias("customer_id"))
    bridge = consumption.customer_meter_bridge(parties, parties, owned(spark, "contract_id"))
    assert len(bridge.collect()) == METERS
    assert "skew=true" in plan(bridge)


def test_a_customer_with_a_third_of_all_meters_is_split(spark, skewed):
    fact = owned(spark, "customer_id").select(
        F.lit(20240101).alias("date_id"),
        "customer_id",
        F.col("meter_id").alias("contract_id"),
        "meter_id",
        F.lit("high").alias("time_of_day"),
        F.rand(7).alias("consumption"),
    )
    customers = spark.range(METERS).select(
        F.col("id").alias("customer_id"),
        F.col("id").cast("string").alias("customer_name"),
        F.lit("commercial").alias("customer_type"),
    )
    meters = spark.range(METERS).select(F.col("id").alias("meter_id"), F.lit("less than 6kV").alias("voltage"))
    days = calendar.calendar(spark)
    prices = seeds.residential_prices(spark), seeds.business_prices(spark)
    jobs = [
        rollups.daily_consumption_by_time_of_day(fact, days, customers, meters),
        revenue.all_revenue(fact, days, customers, meters, *prices),
        revenue.monthly_consumption(fact, days, customers, "commercial"),
    ]
    for job in jobs:
        assert len(job.collect()) == METERS
        assert "skew=true" in plan(job)


def test_a_meter_with_a_third_of_all_readings_is_split(spark, skewed):
    readings = owned(spark, "owner").select(
        F.col("owner").alias("meter_id"),
        (F.rand(7) * 1000).alias("measure"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("datetime_measured"),
    )
    kinds = spark.range(METERS).select(F.col("id").alias("meter_id"), F.lit("industrial").alias("customer_type"))
    rows = checks.out_of_range(readings, kinds)
    assert len(rows.collect()) > 0
    assert "skew=true" in plan(rows)
