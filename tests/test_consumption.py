from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F
from rows import bag, table

from wattfold import schemas
from wattfold.operators import consumption
from wattfold.plans.testbed import Testbed

READING = "meter_id bigint, measure double, datetime_measured timestamp_ntz"


def bridge(spark):
    rows = [(meter, 1000 + meter, 2000 + meter) for meter in (1, 2, 3, 4)]
    return table(spark, "meter_id bigint, customer_id bigint, contract_id bigint", *rows)


def test_daily_consumption_golden(spark):
    first, second = datetime(2023, 7, 1), datetime(2023, 7, 2)
    hours = {1: 10, 2: 18, 3: 23, 4: 2}
    measures = {1: (5.0, 4.0), 2: (3.0, 3.5), 3: (2.0, 2.5), 4: (1.5, 1.0)}
    readings = [
        (meter, value, day.replace(hour=hours[meter]))
        for meter, values in measures.items()
        for day, value in zip((first, second), values)
    ]
    fact = consumption.daily_consumption(table(spark, READING, *readings), bridge(spark))
    band = {1: "high", 2: "high", 3: "low", 4: "low"}
    expected = [
        (20230701 + n, 1000 + meter, 2000 + meter, meter, band[meter], value)
        for meter, values in measures.items()
        for n, value in enumerate(values)
    ]
    assert fact.columns == list(schemas.CONSUMPTION_FACT)
    assert bag(fact) == Counter(expected)


def test_readings_of_a_band_add_up_and_unknown_meters_fall_out(spark):
    day = datetime(2023, 7, 1)
    readings = table(
        spark,
        READING,
        (1, 1.0, day.replace(hour=10)),
        (1, 2.0, day.replace(hour=20, minute=59)),
        (1, 4.0, day.replace(hour=12)),
        (9, 8.0, day.replace(hour=12)),
        (None, 8.0, day),
        (2, 3.0, None),
        (2, None, day),
    )
    fact = consumption.daily_consumption(readings, bridge(spark))
    got = bag(fact, "meter_id", "date_id", "time_of_day", "consumption")
    assert got == Counter(
        [(1, 20230701, "high", 3.0), (1, 20230701, "normal", 4.0), (2, None, "normal", 3.0), (2, 20230701, "low", None)]
    )


def test_bridge_needs_all_three_tables(spark):
    customers = table(spark, "customer_id bigint", (1,), (2,))
    contracts = table(spark, "contract_id bigint, customer_id bigint", (10, 1), (20, 2), (30, 3))
    meters = table(spark, "meter_id bigint, contract_id bigint", (100, 10), (101, 10), (200, 20), (300, 30), (400, 40))
    got = bag(consumption.customer_meter_bridge(customers, contracts, meters))
    assert got == Counter([(1, 10, 100), (1, 10, 101), (2, 20, 200)])


def test_the_fact_keeps_every_joined_reading(spark, small):
    bed = Testbed(spark, small)
    joined = bed.readings().join(bed.bridge(), "meter_id").agg(F.sum("measure")).first()[0]
    assert bed.consumption().agg(F.sum("consumption")).first()[0] == joined


def test_a_hot_meter_gives_the_same_sums(spark):
    """A third of all readings on one meter, on one day and in one band."""
    noise = spark.range(20000).select(
        (F.col("id") % 4 + 1).alias("meter_id"),
        F.lit(1).cast("decimal(8,2)").alias("measure"),
        F.timestamp_add("HOUR", (F.col("id") % 24).cast("int"), F.lit("2023-07-01").cast("timestamp_ntz")).alias(
            "datetime_measured"
        ),
    )
    hot = spark.range(10000).select(
        F.lit(1).cast("bigint").alias("meter_id"),
        F.lit(1).cast("decimal(8,2)").alias("measure"),
        F.lit("2023-07-01 10:30:00").cast("timestamp_ntz").alias("datetime_measured"),
    )
    fact = consumption.daily_consumption(noise.unionByName(hot), bridge(spark))
    total = {(r.meter_id, r.time_of_day): int(r.consumption) for r in fact.collect()}
    per_hour_and_meter = Counter((n % 4 + 1, n % 24) for n in range(20000))
    band = lambda h: "high" if h in (10, 11, 18, 19, 20) else "low" if h in (23, 0, 1, 2, 3, 4) else "normal"
    want = Counter({(1, "high"): 10000})
    for (meter, hour), n in per_hour_and_meter.items():
        want[meter, band(hour)] += n
    assert total == dict(want)
