from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import bag, table

from wattfold import schemas
from wattfold.functions import segments, tariff
from wattfold.operators import calendar, revenue
from wattfold.plans.catalog import QUERIES
from wattfold.plans.testbed import Testbed
from wattfold.sources import seeds

MONTHLY = "customer_id bigint, contract_id bigint, meter_id bigint, date_id int, consumption double"
TIERS = "tier int, price double"
BANDS = "voltage_tier string, time_of_day string, price double"


def slab_by_hand(usage, rates):
    """Kilowatt hours charged slab by slab."""
    if usage is None:
        return None
    if usage <= 50:
        return usage * rates[0]
    charged, lower = 0.0, 0
    for upper, rate in zip([50, 100, 200, 300, 400, float("inf")], rates):
        charged += max(0.0, min(usage, upper) - lower) * rate
        lower = upper
    return charged


def test_residential_golden(spark):
    usage = {1: 100.0, 2: 60.0, 3: 150.0, 4: 300.0}
    monthly = table(spark, MONTHLY, *[(m, m, m, 20230701, kwh) for m, kwh in usage.items()])
    prices = table(spark, TIERS, *[(tier, tier * 1000.0) for tier in (4, 2, 6, 1, 3, 5)])
    bills = revenue.residential_revenue(monthly, prices)
    assert bills.columns == list(schemas.REVENUE_FACT)
    assert bag(bills, "meter_id", "revenue") == Counter([(1, 150000.0), (2, 70000.0), (3, 300000.0), (4, 850000.0)])


EDGES = [None, -1.0, 0.0, 49.99, 50.0, 50.01, 51.0, 99.99, 100.0, 100.01, 199.5, 200.0, 200.01, 300.0, 300.01, 400.0, 400.01, 401.0, 12345.0]


@pytest.mark.parametrize("by_parts", [False, True])
def test_every_slab_edge(spark, by_parts):
    rates = [1806.0, 1866.0, 2167.0, 2729.0, 3050.0, 3151.0]
    monthly = table(spark, MONTHLY, *[(n, n, n, 20230701, usage) for n, usage in enumerate(EDGES)])
    bills = revenue.residential_revenue(monthly, seeds.residential_prices(spark), by_parts)
    got = {row.meter_id: row.revenue for row in bills.collect()}
    for n, usage in enumerate(EDGES):
        want = slab_by_hand(usage, rates)
        assert got[n] == (want if want is None else pytest.approx(want)), usage


def test_a_repeated_tier_is_an_error(spark):
    monthly = table(spark, MONTHLY, (1, 1, 1, 20230701, 10.0))
    prices = table(spark, TIERS, (1, 1.0), (1, 2.0))
    with pytest.raises(Exception, match="one for each tier"):
        revenue.residential_revenue(monthly, prices).collect()


def test_price_per_slab_comes_from_its_tier_number(spark):
    prices = spark.range(1).select(tariff.price_by_tier(seeds.residential_prices(spark)).alias("by_tier"))
    rates = tariff.slab_rates(F.col("by_tier"))
    row = prices.select(*[rate.alias(f"t{n}") for n, rate in enumerate(rates)]).first()
    assert [int(price) for price in row] == [1806, 1866, 2167, 2729, 3050, 3151]


def band_case(spark, tiers):
    """Each meter uses 100 low, 200 normal and 300 high at its own voltage."""
    rows = [
        (meter, meter, meter, 20231001, band, tier, used)
        for meter, tier in enumerate(tiers, 1)
        for band, used in (("low", 100.0), ("normal", 200.0), ("high", 300.0))
    ]
    return table(spark, MONTHLY.replace("consumption", "time_of_day string, voltage string, consumption"), *rows)


PRICE_ROWS = {
    "less than 6kV": (1000.0, 2000.0, 3000.0),
    "6kV to less than 22kV": (4000.0, 5000.0, 6000.0),
    "22kV and above": (7000.0, 8000.0, 9000.0),
    "22kV to less than 100kV": (7000.0, 8000.0, 9000.0),
    "100kV and above": (11000.0, 10000.0, 12000.0),
}


@pytest.mark.parametrize(
    "tiers, bills",
    [
        (["less than 6kV", "6kV to less than 22kV", "22kV and above"], [1400000.0, 3200000.0, 5000000.0]),
        (
            ["less than 6kV", "6kV to less than 22kV", "22kV to less than 100kV", "100kV and above"],
            [1400000.0, 3200000.0, 5000000.0, 6700000.0],
        ),
    ],
)
def test_time_of_use_golden(spark, tiers, bills):
    prices = [
        (tier, band, price) for tier in tiers for band, price in zip(("low", "normal", "high"), PRICE_ROWS[tier])
    ]
    got = revenue.time_of_use_revenue(band_case(spark, tiers), table(spark, BANDS, *prices))
    assert bag(got) == Counter((20231001, n, n, n, bill) for n, bill in enumerate(bills, 1))


def test_a_meter_without_a_price_earns_nothing(spark):
    got = revenue.time_of_use_revenue(band_case(spark, ["less than 6kV", None, "5 V"]), seeds.commercial_prices(spark))
    assert {row.meter_id for row in got.collect()} == {1}


def test_seed_sizes(spark):
    assert seeds.residential_prices(spark).count() == 6
    assert seeds.commercial_prices(spark).count() == 9
    assert seeds.industrial_prices(spark).count() == 12
    assert seeds.business_prices(spark).groupBy("customer_type").count().collect().__len__() == 2


def test_one_pass_equals_the_three_jobs(spark, small):
    keys = schemas.REVENUE_FACT
    apart = Counter()
    for segment in segments.SEGMENTS:
        apart += bag(QUERIES[f"revenue_{segment}"](spark, small), *keys)
    assert bag(QUERIES["fact_revenue"](spark, small), *keys) == apart


def test_one_pass_ignores_other_segments_and_missing_meters(spark):
    day, fact_columns = 20230705, "customer_id bigint, contract_id bigint, meter_id bigint, date_id int, time_of_day string, consumption decimal(18,2)"
    ten = Decimal("10.00")
    fact = table(spark, fact_columns, *[(n, n, n, day, "normal", ten) for n in (1, 2, 3, 4, 5)])
    customers = table(
        spark,
        "customer_id bigint, customer_type string",
        (1, "residential"),
        (2, "commercial"),
        (3, "Residential"),
        (4, "commercial"),
        (5, "industrial"),
    )
    meters = table(spark, "meter_id bigint, voltage string", (2, "less than 6kV"), (5, "22kV and above"))
    got = revenue.all_revenue(
        fact,
        calendar.calendar(spark),
        customers,
        meters,
        seeds.residential_prices(spark),
        seeds.business_prices(spark),
    )
    # Meter 1 is billed without a row in the meter table, 3 has no known segment, 4 no
    # voltage, and the commercial tier of 5 is not in the industrial list.
    assert {(r.meter_id, int(r.revenue), r.customer_type) for r in got.collect()} == {
        (1, 18060, "residential"),
        (2, 28700, "commercial"),
    }


def test_a_month_can_be_billed_alone(spark, small):
    bed = Testbed(spark, small)
    month = revenue.monthly_consumption(
        bed.consumption(), bed.dim_date(), bed.customers(), segments.RESIDENTIAL, year=2024, month=1
    )
    everything = QUERIES["monthly_consumption_residential"](spark, small)
    want = everything.where(F.col("date_id") == 20240101)
    got = month.withColumn("consumption", F.col("consumption").cast("double"))
    assert bag(got, *want.columns) == bag(want)
    assert month.count() > 0


def test_half_a_month_is_refused(spark, small):
    bed = Testbed(spark, small)
    with pytest.raises(ValueError):
        revenue.month_slice(bed.consumption(), bed.dim_date(), year=2024)


def test_preview_is_ordered_and_short(spark, small):
    rows = QUERIES["preview_revenue_top20"](spark, small).collect()
    keys = [(r.customer_id, r.contract_id, r.meter_id, r.date_id) for r in rows]
    assert len(rows) == 20 and keys == sorted(keys)
