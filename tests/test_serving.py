"""Stored roll-ups that follow the facts, and dimensions that are loaded by buckets."""

import os
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import bag, table

from wattfold.operators import calendar, dimensions, rollups
from wattfold.plans import dimension_store, jobs, serving
from wattfold.sinks import snapshots

FACT = "date_id int, customer_id bigint, contract_id bigint, meter_id bigint, time_of_day string, consumption double"
BILL = "date_id int, customer_id bigint, contract_id bigint, meter_id bigint, revenue double, customer_type string"
DAY = date(2023, 7, 2)


@pytest.fixture
def star(spark, folder):
    customers = table(
        spark,
        "customer_id bigint, customer_name string, phone string, email string, address string, customer_type string, updated_date date",
        *[(n, f"c{n}", "", "", "", ["residential", "commercial"][n % 2], DAY) for n in range(4)],
    )
    meters = table(
        spark,
        "meter_id bigint, meter_type string, voltage string, status string, location string, latitude double, "
        "longitude double, iso_code string, updated_date date",
        *[(n, "x", None, "active", f"p{n % 2}", 1.0, 1.0, None, DAY) for n in range(4)],
    )
    jobs.load_calendar(spark, folder, date(2023, 6, 1), date(2023, 8, 31))
    jobs.load_dimension(spark, customers, folder, "dim_customer", "a")
    jobs.load_dimension(spark, meters, folder, "dim_electric_meter", "a")
    return customers, meters


def land(spark, folder, land_day, *rows):
    fact = table(spark, FACT, *[(day, meter, meter, meter, "low", amount) for day, meter, amount in rows])
    snapshots.replace_slice(fact, f"{folder}/fact_power_consumption", "land_day", land_day, "date_id")


def bill(spark, folder, month, *amounts):
    rows = table(spark, BILL, *[(month, n, n, n, amount, ["r", "c"][n % 2]) for n, amount in enumerate(amounts)])
    snapshots.replace_slice(rows, f"{folder}/fact_revenue", "date_id", month, "customer_type")


def written(spark, folder, view):
    """The folder of each period of a stored roll-up."""
    return {name: part.folder for name, part in snapshots.current(spark, f"{folder}/views/{view}").slices.items()}


def assert_equal_to_the_whole(spark, folder):
    views = rollups.all_rollups(*jobs._star(spark, folder, "a"))
    for name, whole in views.items():
        stored = serving.read_view(spark, folder, name)
        assert bag(stored, *whole.columns) == bag(whole, *whole.columns), name


def test_a_late_landing_day_writes_only_the_days_it_touches(spark, folder, star):
    land(spark, folder, 20230702, (20230630, 0, 1.0), (20230701, 0, 2.0), (20230701, 1, 4.0))
    land(spark, folder, 20230703, (20230702, 2, 8.0))
    bill(spark, folder, 20230701, 10.0, 20.0)
    first = jobs.store_views(spark, folder, "a")
    assert len(first) == 9 and first["daily_total_consumption"] == {"20230630", "20230701", "20230702"}
    assert first["monthly_total_revenue"] == {"20230701"}
    assert_equal_to_the_whole(spark, folder)
    assert not any(jobs.store_views(spark, folder, "a").values())

    before = written(spark, folder, "daily_consumption_by_customer")
    land(spark, folder, 20230709, (20230701, 3, 16.0), (20230708, 3, 1.0))
    bill(spark, folder, 20230801, 5.0)
    again = jobs.store_views(spark, folder, "a")
    assert again["daily_consumption_by_customer"] == {"20230701", "20230708"}
    assert again["monthly_revenue_by_customer"] == {"20230801"}
    after = written(spark, folder, "daily_consumption_by_customer")
    assert {name for name in after if after[name] != before.get(name)} == {"date_id=20230701", "date_id=20230708"}
    assert_equal_to_the_whole(spark, folder)


def test_a_replaced_slice_takes_its_old_days_along(spark, folder, star):
    land(spark, folder, 20230702, (20230630, 0, 1.0), (20230701, 0, 2.0))
    land(spark, folder, 20230703, (20230701, 1, 4.0))
    jobs.store_views(spark, folder, "a")
    land(spark, folder, 20230702, (20230701, 0, 3.0))  # the day before is gone
    assert jobs.store_views(spark, folder, "a")["daily_total_consumption"] == {"20230630", "20230701"}
    assert bag(serving.read_view(spark, folder, "daily_total_consumption")) == Counter([(1, 7, 2023, 7.0)])
    days = spark.read.parquet(f"{folder}/dim_date")
    whole = rollups.daily_total_consumption(snapshots.read(spark, f"{folder}/fact_power_consumption"), days)
    assert bag(serving.read_view(spark, folder, "daily_total_consumption")) == bag(whole)


def test_another_version_of_the_dimensions_makes_all_days_again(spark, folder, star):
    land(spark, folder, 20230702, (20230701, 0, 2.0))
    jobs.store_views(spark, folder, "a")
    renamed = star[0].withColumns({"customer_name": F.lit("new"), "updated_date": F.lit(date(2023, 8, 1))})
    jobs.load_dimension(spark, renamed, folder, "dim_customer", "b", previous="a")
    jobs.load_dimension(spark, star[1], folder, "dim_electric_meter", "b", previous="a")
    assert jobs.store_views(spark, folder, "b")["daily_consumption_by_customer"] == {"20230701"}
    assert serving.read_view(spark, folder, "daily_consumption_by_customer").first().customer_name == "new"


CUSTOMER = "customer_id bigint, customer_name string, phone string, email string, address string, customer_type string, updated_date date"


def customers(spark, *rows):
    return table(spark, CUSTOMER, *[(n, name, "", "", "", "residential", day) for n, name, day in rows])


def files_of(spark, path):
    return {name: part.folder for name, part in snapshots.current(spark, path).slices.items()}


def test_a_load_writes_only_buckets_with_fresh_keys(spark, folder):
    first = [(n, f"c{n}", date(2023, 7, 1)) for n in range(200)]
    loaded = dimension_store.upsert(spark, customers(spark, *first), folder, dimensions.CUSTOMER, buckets=16)
    assert loaded == (200, 0, 16)
    before = files_of(spark, folder)
    fresh = [(5, "new", date(2023, 7, 3)), (5, "old", date(2023, 7, 2)), (900, "more", date(2023, 7, 2)), (None, "x", date(2023, 7, 3))]
    source = customers(spark, *first, *fresh)
    loaded = dimension_store.upsert(spark, source, folder, dimensions.CUSTOMER)
    assert loaded.rows == 2 and loaded.null_keys == 1 and 1 <= loaded.buckets <= 2
    after = files_of(spark, folder)
    assert sum(after[name] != before[name] for name in after) == loaded.buckets
    want = {**{n: name for n, name, _ in first}, 5: "new", 900: "more"}
    got = dimension_store.read(spark, folder, dimensions.CUSTOMER)
    assert {row.customer_id: row.customer_name for row in got.collect()} == want and got.count() == len(want)
    # The same load again finds nothing newer.
    assert dimension_store.upsert(spark, source, folder, dimensions.CUSTOMER).rows == 0
    assert files_of(spark, folder) == after


def test_the_date_loaded_to_is_known_without_reading_the_table(spark, folder):
    rows = customers(spark, (1, "a", date(2023, 7, 1)), (2, "b", None))
    assert dimension_store.upsert(spark, rows, folder, dimensions.CUSTOMER).rows == 1
    assert snapshots.current(spark, folder).notes["loaded_to"] == "2023-07-01"
    assert dimension_store.upsert(spark, rows, folder, dimensions.CUSTOMER, today=date(2023, 7, 5)).rows == 1
    assert dimension_store.read(spark, folder, dimensions.CUSTOMER).count() == 2


def test_silent_edits_are_found_in_the_buckets_that_differ(spark, folder):
    day = date(2023, 7, 1)
    rows = [(n, f"c{n}", day) for n in range(200)]
    dimension_store.upsert(spark, customers(spark, *rows), folder, dimensions.CUSTOMER, buckets=16)
    assert dimension_store.reconcile(spark, customers(spark, *rows), folder, dimensions.CUSTOMER).buckets == ()
    # Edited with its date kept, added with an old date, added without a date, and gone from the source.
    edited = [*rows[1:50], (50, "edited", day), *rows[51:], (900, "late", date(2020, 1, 1)), (901, "no date", None)]
    source = customers(spark, *edited)
    found = dimension_store.reconcile(spark, source, folder, dimensions.CUSTOMER)
    assert bag(found.keys) == Counter([(50, "edited"), (900, "missing"), (901, "missing"), (0, "extra")])
    assert 1 <= len(found.buckets) <= 4
    # The other buckets' files are not needed.
    for name, part in snapshots.current(spark, folder).slices.items():
        if int(name.split("=")[1]) not in found.buckets:
            for file in os.listdir(f"{folder}/{part.folder}"):
                open(f"{folder}/{part.folder}/{file}", "wb").close()
    assert found.keys.count() == 4


def test_differences_can_be_loaded(spark, folder):
    day = date(2023, 7, 1)
    jobs.upsert_dimension(spark, customers(spark, (1, "a", day), (2, "b", day)), folder, "dim_customer")
    source = customers(spark, (1, "edited", day), (3, "new", None), (3, "newer", date(2020, 1, 1)))
    assert jobs.reconcile_dimension(spark, source, folder, "dim_customer") == {"edited": 1, "missing": 1, "extra": 1}
    jobs.reconcile_dimension(spark, source, folder, "dim_customer", load=True)
    got = dimension_store.read(spark, f"{folder}/current/dim_customer", dimensions.CUSTOMER)
    assert bag(got, "customer_id", "customer_name") == Counter([(1, "edited"), (2, "b"), (3, "newer")])
    assert jobs.reconcile_dimension(spark, source, folder, "dim_customer") == {"extra": 1}


def test_a_calendar_of_a_later_load_is_used(spark):
    assert calendar.calendar(spark, DAY, DAY).count() == 1
