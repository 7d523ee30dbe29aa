"""Inputs that earlier gave wrong results without an error."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattfold import settings
from wattfold.functions import tariff
from wattfold.operators import dimensions
from wattfold.plans import jobs
from wattfold.plans.catalog import QUERIES
from wattfold.sinks import snapshots
from wattfold.streaming import ingest


def test_a_month_outside_the_calendar_leaves_bills_alone(spark, folder):
    jobs.load_calendar(spark, folder)
    bills = f"{folder}/fact_revenue"
    rows = spark.range(3).select(F.col("id").alias("meter_id"), F.lit("x").alias("customer_type"), F.lit(20250601).alias("date_id"))
    published = snapshots.replace_slice(rows, bills, "date_id", 20250601, "customer_type")
    jobs.seed_prices(spark, folder)
    prices = jobs.read_prices(spark, folder)
    with pytest.raises(ValueError, match="2025-06"):
        jobs.load_revenue(spark, folder, 2025, 6, "v", prices)
    assert snapshots.read(spark, bills).count() == 3 and snapshots.current(spark, bills) == published
    jobs.load_calendar(spark, folder, date(2025, 6, 1), date(2025, 6, 30))
    with pytest.raises(FileNotFoundError, match="fact_power_consumption"):  # the calendar is no obstacle now, the fact is missing
        jobs.load_revenue(spark, folder, 2025, 6, "v", prices)


@pytest.mark.parametrize("tiers", [[1, 3, 4, 5, 6], [1, 2, 3, 4, 5, 6, 7], [1, 2, 2, 3, 4, 5, 6], [1, 2, 3, 4, 5, None]])
def test_price_lists_that_are_no_six_tiers(spark, tiers):
    prices = spark.createDataFrame([(tier, 10.0) for tier in tiers], "tier int, price double")
    usage = spark.createDataFrame([(70.0,)], "usage double")
    charge = tariff.slab_charge(F.col("usage"), tariff.slab_rates(tariff.price_by_tier(prices)))
    with pytest.raises(Exception, match="one for each tier"):
        usage.select(charge).collect()


def test_meters_for_any_count(spark):
    contracts = spark.createDataFrame([(i, i - 1) for i in range(1, 7)], "contract_id long, n int")
    rows = dimensions.meters_for_contracts(contracts, F.col("n")).collect()
    ids = [row.meter_id for row in rows]
    assert len(ids) == len(set(ids)) == 0 + 1 + 2 + 3 + 4 + 5
    with pytest.raises(Exception, match="at most five"):
        dimensions.meters_for_contracts(contracts, F.col("n") + 1).collect()


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Ho_Chi_Minh", "America/New_York"])
def test_delay_and_landing_day_do_not_depend_on_the_session_zone(spark, folder, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        # Measured at 23:30 seven hours east of UTC, arrived 250 ms later.
        sent = spark.sql("SELECT CAST('1,1.0,2024-01-01 23:30:00' AS BINARY) AS value, TIMESTAMP '2024-01-01 16:30:00.25Z' AS timestamp")
        delays = ingest.ingest_delay(ingest.parse_messages(sent), F.col("timestamp"), "Asia/Ho_Chi_Minh")
        assert [row.delay_ms for row in delays.collect()] == [250]
        sent.write.parquet(f"{folder}/topic")
        messages = spark.readStream.schema(sent.schema).parquet(f"{folder}/topic")
        jobs.start_landing(messages, f"{folder}/files", f"{folder}/checkpoint", None, zone="Asia/Ho_Chi_Minh").awaitTermination()
        assert "land_day=20240101" in os.listdir(f"{folder}/files")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_readings_are_neither_broadcast_nor_shuffled_for_their_load_factor(spark, small):
    for name in ("load_factor", "load_band_check"):
        rows = QUERIES[name](spark, small)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BuildRight" in plan and "BuildLeft" not in plan and "Exchange hashpartitioning" not in plan


def test_only_finite_measures_are_valid(spark):
    lines = [f"1,{measure},2024-01-01 00:00:00" for measure in ("2.5", "NaN", "Infinity", "-Infinity")]
    messages = spark.createDataFrame([(line,) for line in lines], "value string")
    assert [row.valid for row in ingest.parse_messages(messages).collect()] == [True, False, False, False]


def test_a_bounded_session_has_small_tasks_and_leaves_the_other_alone(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name), spark.conf.get("spark.sql.shuffle.partitions")
    large = settings.bounded_session(spark, 1_000_000_000)
    assert int(large.conf.get(name)) <= settings.TASK_BYTES
    assert int(large.conf.get("spark.sql.shuffle.partitions")) == 1_000_000_000 // settings.TASK_ROWS
    assert (spark.conf.get(name), spark.conf.get("spark.sql.shuffle.partitions")) == before
    assert settings.bounded_session(spark, 10).conf.get("spark.sql.shuffle.partitions") == before[1]


def test_queries_over_consumption_run_in_a_bounded_session(spark):
    for name in ("view_daily_consumption_by_time_of_day", "fact_revenue", "check_pk_duplicates"):
        session = QUERIES[name](spark, "/root/testdata/sf0.001").sparkSession
        assert int(session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 8 << 20


def test_a_bounded_session_reads_small_parts_of_files(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    assert settings.byte_count(settings.bounded_session(spark, 10).conf.get(name)) <= 32 << 20
    assert spark.conf.get(name) == before
    spark.conf.set(name, "4m")
    try:
        assert settings.byte_count(settings.bounded_session(spark, 10).conf.get(name)) == 4 << 20
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize(("size", "want"), [("67108864b", 1 << 26), ("64MB", 1 << 26), ("8m", 1 << 23), ("100", 100), ("2g", 1 << 31)])
def test_sizes_are_read_with_any_unit(size, want):
    assert settings.byte_count(size) == want
