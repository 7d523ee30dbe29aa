from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import table

from wattfold.functions import keys

HIGH, LOW = {10, 11, 18, 19, 20}, {23, 0, 1, 2, 3, 4}


def test_every_hour_has_its_band(spark):
    rows = [(datetime(2023, 7, 1, hour, 59, 59),) for hour in range(24)]
    moments = table(spark, "at timestamp_ntz", *rows)
    got = {r.at.hour: r.band for r in moments.select("at", keys.time_of_day(F.col("at")).alias("band")).collect()}
    assert got == {h: "high" if h in HIGH else "low" if h in LOW else "normal" for h in range(24)}


def test_a_missing_instant_is_normal_and_has_no_date(spark):
    row = table(spark, "at timestamp_ntz", (None,)).select(
        keys.time_of_day(F.col("at")).alias("band"), keys.date_id(F.col("at")).alias("day")
    ).first()
    assert tuple(row) == ("normal", None)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh", "America/New_York"])
def test_wall_clock_keys_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = keys.moment_literal(datetime(2024, 3, 10, 23, 30))
        row = spark.range(1).select(keys.date_id(at).alias("day"), keys.time_of_day(at).alias("band")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (20240310, "low")


def test_month_key_is_the_first_day(spark):
    row = spark.sql("SELECT 2024 AS y, 12 AS m").select(keys.month_id(F.col("y"), F.col("m")).alias("id")).first()
    assert row.id == 20241201


@pytest.mark.parametrize("month", [0, 13])
def test_a_month_outside_the_year_is_refused(month):
    with pytest.raises(ValueError):
        keys.month_bounds(2024, month)
