"""The pipeline from landed files to the serving views."""

import contextlib
import io
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import bag, table

import run_job
from wattfold.plans import jobs, serving
from wattfold.sinks import snapshots
from wattfold.sources import queue
from wattfold.streaming import ingest

DAY = date(2023, 7, 2)


@pytest.fixture
def operational(spark):
    contact = ("1", "a@b", "street")
    customers = table(
        spark,
        "customer_id bigint, customer_name string, phone string, email string, address string, customer_type string, updated_date date",
        (1, "Home", *contact, "residential", DAY),
        (2, "Shop", *contact, "commercial", DAY),
    )
    contracts = table(
        spark,
        "contract_id bigint, customer_id bigint, date_created date, status string, updated_date date",
        (10, 1, DAY, "active", DAY),
        (20, 2, DAY, "active", DAY),
    )
    meters = table(
        spark,
        "meter_id bigint, contract_id bigint, meter_type string, voltage string, status string, location string, "
        "latitude double, longitude double, iso_code string, updated_date date",
        (100, 10, "single-phase", None, "active", "Huế", 1.0, 2.0, "VN-26", DAY),
        (200, 20, "three-phase", "less than 6kV", "active", "Huế", 1.0, 2.0, "VN-26", DAY),
    )
    return customers, contracts, meters


def land(folder, name, *lines):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write("\n".join(("meter_id,measure,datetime_measured", *lines)) + "\n")


def test_pipeline(spark, folder, operational):
    customers, contracts, meters = operational
    warehouse = f"{folder}/warehouse"
    jobs.load_calendar(spark, warehouse)
    for name, source in (("dim_customer", customers), ("dim_contract", contracts), ("dim_electric_meter", meters)):
        jobs.load_dimension(spark, source, warehouse, name, "a")
        jobs.load_dimension(spark, source, warehouse, name, "b", previous="a")
    land(folder, "readings_20230701230000.csv", "100,60,2023-07-01 12:00:00", "200,10,2023-07-01 10:00:00", "999,5,2023-07-01 10:00:00")
    land(folder, "readings_20230702000000.csv", "100,40,2023-07-01 12:30:00", "200,1,2023-07-02 23:00:00")
    for land_day in (date(2023, 7, 1), DAY, DAY):
        jobs.load_consumption(
            spark, f"{folder}/readings_{{day}}*.csv", land_day, customers, contracts, meters, warehouse
        )
    jobs.seed_prices(spark, folder)
    for _ in range(2):
        jobs.load_revenue(spark, warehouse, 2023, 7, "b", jobs.read_prices(spark, folder))
    assert len(jobs.serve_views(spark, warehouse, "b")) == 9
    assert bag(spark.table("daily_total_consumption")) == Counter([(1, 7, 2023, 110.0), (2, 7, 2023, 1.0)])
    bills = bag(spark.table("monthly_revenue_by_customer"), "customer_id", "month", "year", "revenue")
    home = 50 * 1806.0 + 50 * 1866.0
    assert bills == Counter([(1, 7, 2023, home), (2, 7, 2023, 10 * 4937.0 + 1 * 1746.0)])
    one_day = spark.sql("SELECT * FROM daily_consumption_by_customer WHERE year = 2023 AND month = 7 AND day = 2")
    with contextlib.redirect_stdout(io.StringIO()) as out:
        one_day.explain("formatted")
    assert "dynamicpruning" in out.getvalue() and one_day.count() == 1
    by_place = bag(spark.table("daily_consumption_by_location"), "iso_code", "day", "consumption")
    assert by_place == Counter([("VN-26", 1, 110.0), ("VN-26", 2, 1.0)])


def test_jobs_by_command(spark, folder, operational, capsys):
    tables, warehouse = f"{folder}/operational", f"{folder}/warehouse"
    for name, frame in zip(run_job.SOURCES.values(), operational):
        frame.write.parquet(f"{tables}/{name}")
    land(folder, "readings_20230702000000.csv", "100,40,2023-07-01 12:30:00", "200,1,2023-07-02 23:00:00")

    def run(command, *options):
        run_job.run(spark, run_job.parser().parse_args([command, *options]))

    run("seed-prices", "--operational", tables)
    run("check", "--operational", tables)
    out, source = ["--warehouse", warehouse], ["--operational", tables]
    run("calendar", *out, "--last", "2024-12-31")
    for name in run_job.SOURCES:
        run("dimension", *out, *source, "--version", "a", "--name", name, "--today", "2023-07-03")
    run("consumption", *out, *source, "--landed", f"{folder}/readings_{{day}}*.csv", "--day", "2023-07-02")
    run("revenue", *out, *source, "--version", "a", "--year", "2023", "--month", "7")
    bills = bag(snapshots.read(spark, f"{warehouse}/fact_revenue"), "date_id", "meter_id", "revenue", "customer_type")
    assert bills == Counter([(20230701, 100, 40 * 1806.0, "residential"), (20230701, 200, 1746.0, "commercial")])
    run("views", *out, "--version", "a")
    stored = serving.read_view(spark, warehouse, "daily_total_consumption")
    assert bag(stored, "day", "month", "year", "consumption") == Counter([(1, 7, 2023, 40.0), (2, 7, 2023, 1.0)])
    assert serving.read_view(spark, warehouse, "monthly_revenue_by_customer").count() == 2
    run("export", "--landed", f"{folder}/readings_*.csv", "--out", f"{folder}/hours")
    hours = spark.read.csv(f"{folder}/hours", header=True)
    assert bag(hours, "meter_id", "hour_stamp") == Counter([("100", 20230701120000), ("200", 20230702230000)])
    said = capsys.readouterr().out
    assert "dim_customer: 0 source rows" in said and "Landed(billed=2, bad=0, unknown=0)" in said
    assert "dim_electric_meter: 2 place names" not in said and "'meters without a contract': 0" in said


def test_landing_stream_feeds_the_daily_job(spark, folder, operational):
    rows = [
        (b"100,1.5,2023-07-01 23:00:00", datetime(2023, 7, 2, 0, 0, 5)),
        (b"100,2.5,2023-07-02 01:00:00", datetime(2023, 7, 2, 1, 0, 5)),
        (b"bad,2.5,2023-07-02 01:00:00", datetime(2023, 7, 2, 1, 0, 5)),
        (b"100,4.0,2023-07-03 01:00:00", datetime(2023, 7, 3, 1, 0, 5)),
    ]
    schema = "value binary, timestamp timestamp_ntz"
    table(spark, schema, *rows).write.parquet(f"{folder}/topic")
    messages = spark.readStream.schema(schema).parquet(f"{folder}/topic")
    jobs.start_landing(messages, f"{folder}/landed", f"{folder}/landed-checkpoint", None).awaitTermination()
    # A file of a batch that never came to its commit does not count.
    land(f"{folder}/landed/land_day=20230702", "part-orphan.csv", "100,99.0,2023-07-02 01:00:00")
    jobs.load_consumption(spark, f"{folder}/landed", DAY, *operational, f"{folder}/warehouse")
    got = bag(snapshots.read(spark, f"{folder}/warehouse/fact_power_consumption"), "date_id", "meter_id", "consumption")
    assert got == Counter([(20230701, 100, 1.5), (20230702, 100, 2.5)])


def test_a_version_is_not_overwritten_by_itself(spark, folder, operational):
    with pytest.raises(ValueError):
        jobs.load_dimension(spark, operational[0], folder, "dim_customer", "a", previous="a")


def test_every_landed_line_is_accounted_for(spark, folder, operational):
    lines = ["100,1,2023-07-01 12:00:00", "100,2,2023-07-01 12:30:00", "999,5,2023-07-01 10:00:00", "999,5,2023-07-01 11:00:00",
             "x,1,2023-07-01 12:00:00", "100,NaN,2023-07-01 12:00:00", "100,1,yesterday", "100"]
    land(folder, "readings_20230702000000.csv", *lines)
    for _ in range(2):
        counts = jobs.load_consumption(spark, f"{folder}/readings_{{day}}*.csv", DAY, *operational, f"{folder}/w")
        assert counts == (2, 4, 2)
    bad = spark.read.parquet(f"{folder}/w/bad_readings")
    assert Counter(row.datetime_measured for row in bad.collect())["yesterday"] == 1
    assert bag(spark.read.parquet(f"{folder}/w/unknown_meters"), "meter_id", "readings") == Counter([(999, 2)])
    assert snapshots.read(spark, f"{folder}/w/fact_power_consumption").where("date_id IS NULL").isEmpty()


def test_decimal_measures_are_summed_exactly(spark, folder, operational):
    lines = [f"100,{measure},2023-07-01 12:00:00" for measure in ("0.1", "0.2", "0.3", "1000000.0", "Infinity")]
    land(folder, "readings_20230702000000.csv", *lines)
    landed = f"{folder}/readings_{{day}}*.csv"
    counts = jobs.load_consumption(spark, landed, DAY, *operational, f"{folder}/w", "decimal(8,2)")
    assert counts == (3, 2, 0)
    fact = snapshots.read(spark, f"{folder}/w/fact_power_consumption")
    assert fact.first().consumption == Decimal("0.60") and fact.count() == 1


def test_readings_are_published_by_command(spark, folder, monkeypatch):
    land(folder, "readings_20230702000000.csv", "100,40,2023-07-01 12:30:00")
    sent = []
    publish = lambda readings, *to: sent.append((queue.as_messages(readings).first(), to))
    monkeypatch.setattr(queue, "publish", publish)
    options = ["--landed", f"{folder}/readings_*.csv", "--servers", "host", "--topic", "readings"]
    run_job.run(spark, run_job.parser().parse_args(["publish", *options]))
    assert sent == [(("100", "100,40.0,2023-07-01 12:30:00"), ("host", "readings"))]


def test_repeated_keys_are_refused(spark, folder, operational):
    customers, contracts, meters = operational
    with pytest.raises(ValueError, match="electric_meter has 2 keys"):
        jobs.load_consumption(spark, f"{folder}/r_{{day}}.csv", DAY, customers, contracts, meters.union(meters), folder)
    orphans = jobs.check_operational(customers.limit(0), contracts, meters)
    assert orphans == {"contracts without a customer": 2, "meters without a contract": 0}


def test_a_changed_price_changes_the_bill(spark, folder, operational):
    warehouse = f"{folder}/warehouse"
    jobs.load_calendar(spark, warehouse)
    jobs.load_dimension(spark, operational[0], warehouse, "dim_customer", "a")
    jobs.load_dimension(spark, operational[2], warehouse, "dim_electric_meter", "a")
    land(folder, "readings_20230702000000.csv", "100,10,2023-07-01 12:30:00", "200,1,2023-07-01 23:00:00")
    jobs.load_consumption(spark, f"{folder}/readings_{{day}}*.csv", DAY, *operational, warehouse)
    jobs.seed_prices(spark, folder)
    seeded = jobs.read_prices(spark, folder)
    dearer = jobs.Prices(*[prices.withColumn("price", F.col("price") + 1) for prices in seeded])
    for prices, home, shop in ((seeded, 18060.0, 1746.0), (dearer, 18070.0, 1747.0)):
        jobs.load_revenue(spark, warehouse, 2023, 7, "a", prices)
        bills = bag(snapshots.read(spark, f"{warehouse}/fact_revenue"), "meter_id", "revenue")
        assert bills == Counter([(100, home), (200, shop)])
    twice = seeded._replace(commercial=seeded.commercial.union(seeded.commercial))
    with pytest.raises(ValueError, match="price list"):
        jobs.load_revenue(spark, warehouse, 2023, 7, "a", twice)


def test_dates_and_places_are_filled_in(spark, folder, operational):
    known = table(spark, "location string, iso_code string, latitude double, longitude double", ("Huế", "VN-26", 1.0, 2.0))
    bare = operational[2].withColumns({"iso_code": F.lit(None).cast("string"), "updated_date": F.lit(None).cast("date")})
    bare = bare.withColumn("location", F.when(F.col("meter_id") == 100, F.col("location")).otherwise("Atlantis"))
    placed, unknown = jobs.placed_meters(bare, known)
    assert unknown == 1
    jobs.load_dimension(spark, placed, folder, "dim_electric_meter", "a", today=DAY)
    rows = bag(spark.read.parquet(f"{folder}/dim_electric_meter"), "meter_id", "iso_code", "updated_date")
    assert rows == Counter([(100, "VN-26", DAY), (200, None, DAY)])


def test_both_layers_drop_the_same_repeats(spark, folder, operational):
    lines = [b"100,1.5,2023-07-01 23:00:00", b"100,2.5,2023-07-02 01:00:00", b"bad"]
    rows = [(line, datetime(2023, 7, 2, 1)) for line in lines * 2]
    schema = "value binary, timestamp timestamp_ntz"
    table(spark, schema, *rows).write.parquet(f"{folder}/topic")
    messages = lambda: spark.readStream.schema(schema).parquet(f"{folder}/topic")
    jobs.start_landing(messages(), f"{folder}/landed", f"{folder}/landed-checkpoint", None).awaitTermination()
    jobs.start_speed_layer(messages(), f"{folder}/speed", f"{folder}/speed-checkpoint", None).awaitTermination()
    assert jobs.load_consumption(spark, f"{folder}/landed", DAY, *operational, f"{folder}/w") == (2, 1, 0)
    fact, speed = snapshots.read(spark, f"{folder}/w/fact_power_consumption"), ingest.read_speed_table(spark, f"{folder}/speed").where("valid")
    assert fact.agg(F.sum("consumption")).first()[0] == speed.agg(F.sum("measure")).first()[0] == 4.0


def test_speed_layer(spark, folder):
    path = f"{folder}/topic"
    lines = [b"1,1.5,2024-01-01 00:00:00", b"1,1.5,2024-01-01 00:00:00", b"bad"]
    table(spark, "value binary", *[(line,) for line in lines]).write.parquet(path)
    messages = lambda: spark.readStream.schema("value binary").parquet(path)
    for delay, rows in (("1 day", 2), (None, 3)):
        out = f"{folder}/speed-{rows}"
        jobs.start_speed_layer(messages(), out, f"{out}-checkpoint", None, delay).awaitTermination()
        assert ingest.read_speed_table(spark, out).count() == rows
