from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F
from rows import bag, table

from wattfold.operators import calendar, rollups
from wattfold.plans.testbed import Testbed

FACT = "date_id int, customer_id bigint, contract_id bigint, meter_id bigint, time_of_day string, consumption decimal(18,2)"


def star(spark):
    fact = table(
        spark,
        FACT,
        (20230701, 1, 1, 1, "high", Decimal("1.50")),
        (20230701, 1, 1, 2, "low", Decimal("2.50")),
        (20230702, 1, 1, 1, "high", Decimal("4.00")),
        (20230701, 2, 2, 3, "high", Decimal("8.00")),
        (20230701, 9, 9, 9, "high", Decimal("16.00")),
        (19000101, 1, 1, 1, "high", Decimal("32.00")),
    )
    customers = table(
        spark, "customer_id bigint, customer_name string, customer_type string", (1, "A", "residential"), (2, "B", "residential")
    )
    meters = table(
        spark, "meter_id bigint, location string, iso_code string", (1, "X", "x"), (2, "X", "x"), (3, None, None), (9, "Y", None)
    )
    return fact, calendar.calendar(spark), customers, meters


def floats(counter):
    return Counter({(*row[:-1], float(row[-1])): n for row, n in counter.items()})


def test_total_needs_only_the_calendar(spark):
    fact, days, _, _ = star(spark)
    got = floats(bag(rollups.daily_total_consumption(fact, days)))
    assert got == Counter([(1, 7, 2023, 28.0), (2, 7, 2023, 4.0)])


def test_by_customer_and_by_type(spark):
    fact, days, customers, _ = star(spark)
    by_customer = floats(bag(rollups.daily_consumption_by_customer(fact, days, customers)))
    assert by_customer == Counter(
        [(1, "A", "residential", 1, 7, 2023, 4.0), (1, "A", "residential", 2, 7, 2023, 4.0), (2, "B", "residential", 1, 7, 2023, 8.0)]
    )
    by_type = floats(bag(rollups.daily_consumption_by_customer_type(fact, days, customers)))
    assert by_type == Counter([("residential", 1, 7, 2023, 12.0), ("residential", 2, 7, 2023, 4.0)])


def test_by_location_groups_missing_places(spark):
    fact, days, _, meters = star(spark)
    got = floats(bag(rollups.daily_consumption_by_location(fact, days, meters)))
    assert got == Counter(
        [("X", "x", 1, 7, 2023, 4.0), ("X", "x", 2, 7, 2023, 4.0), (None, None, 1, 7, 2023, 8.0), ("Y", None, 1, 7, 2023, 16.0)]
    )


def test_by_meter_and_band(spark):
    fact, days, customers, meters = star(spark)
    got = floats(bag(rollups.daily_consumption_by_time_of_day(fact, days, customers, meters)))
    assert got == Counter(
        [
            (1, "A", 1, "high", 1, 7, 2023, 1.5),
            (1, "A", 2, "low", 1, 7, 2023, 2.5),
            (1, "A", 1, "high", 2, 7, 2023, 4.0),
            (2, "B", 3, "high", 1, 7, 2023, 8.0),
        ]
    )
    by_meter = floats(bag(rollups.daily_consumption_by_meter(fact, days, customers, meters)))
    assert sum(row[-1] * n for row, n in by_meter.items()) == 16.0


def test_customers_add_up_to_types_and_total(spark, small):
    bed = Testbed(spark, small)
    fact, days, customers = bed.consumption(), bed.dim_date(), bed.customers()
    period = ["day", "month", "year"]
    by_customer = rollups.daily_consumption_by_customer(fact, days, customers)
    summed = by_customer.groupBy(*period).agg(F.sum("consumption").alias("consumption"))
    total = rollups.daily_total_consumption(fact, days)
    assert floats(bag(summed, *period, "consumption")) == floats(bag(total, *period, "consumption"))


def test_views_can_be_queried_by_name(spark):
    fact, days, customers, meters = star(spark)
    bills = table(
        spark,
        "date_id int, customer_id bigint, contract_id bigint, meter_id bigint, revenue decimal(18,2)",
        (20230701, 1, 1, 1, Decimal("10.00")),
        (20230701, 2, 2, 3, Decimal("5.00")),
    )
    names = rollups.register_views(fact, bills, days, customers, meters)
    again = rollups.register_views(fact, bills, days, customers, meters)
    assert names == again and len(names) == 9
    for name in names:
        assert spark.table(name).count() > 0
    assert spark.sql("SELECT revenue FROM monthly_total_revenue").first()[0] == Decimal("15.00")
    assert spark.sql("SELECT count(*) FROM monthly_revenue_by_customer").first()[0] == 2
