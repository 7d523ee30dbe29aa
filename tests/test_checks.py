import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import bag, table

from wattfold.functions import segments
from wattfold.operators import checks, places
from wattfold.sources import seeds


def test_duplicate_keys_counts_nulls_as_a_value(spark):
    rows = table(spark, "a int, b int", (1, 1), (1, 1), (1, 2), (None, 1), (None, 1), (None, 1))
    assert bag(checks.duplicate_keys(rows, ["a", "b"])) == Counter([(1, 1, 2), (None, 1, 3)])


def test_unique_lets_nulls_repeat(spark):
    rows = table(spark, "a int, b int", (1, 1), (1, 1), (None, 1), (None, 1), (2, None), (2, None))
    assert bag(checks.unique_violations(rows, ["a", "b"])) == Counter([(1, 1, 2)])
    assert bag(checks.unique_violations(rows, ["a"])) == Counter([(1, 2), (2, 2)])


def test_orphans_are_counted_once_per_value(spark):
    child = table(spark, "k int", (1,), (2,), (2,), (2,), (None,))
    parent = table(spark, "k int", (1,), (3,))
    assert bag(checks.orphans(child, parent, "k")) == Counter([(2, 3)])


def factor_by_hand(segment, at):
    weekday, hour, quarter = at.weekday(), at.hour, (at.month - 1) // 3 + 1
    if segment != "residential":
        return "1.0" if weekday <= 4 and 8 <= hour <= 17 else "0.6"
    if weekday >= 5:
        return "1.0" if hour >= 8 else "0.6"
    if quarter in (1, 3):
        return "1.0" if hour >= 17 else "0.6"
    return "1.3" if hour >= 17 else "0.9"


def test_load_factor_over_a_year(spark):
    """Every hour of one week in each month, for each segment."""
    moments = [
        datetime(2024, month, 1) + timedelta(hours=hour, minutes=59) for month in range(1, 13) for hour in range(7 * 24)
    ]
    rows = [(segment, at) for segment in segments.SEGMENTS for at in moments]
    factor = segments.load_factor(F.col("segment"), F.col("at")).alias("factor")
    got = table(spark, "segment string, at timestamp_ntz", *rows).select("segment", "at", factor).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.factor == Decimal(factor_by_hand(row.segment, row.at)), row


def test_segment_of_contract_edges(spark):
    ids = [0, 1, 10000, 10001, 10100, 10101, 10201]
    got = table(spark, "id bigint", *[(n,) for n in ids]).select(segments.segment_of_contract(F.col("id"))).collect()
    home, shop, plant = segments.SEGMENTS
    assert [row[0] for row in got] == [plant, home, home, shop, shop, plant, plant]


def test_out_of_range_keeps_both_bounds_in(spark):
    office = datetime(2024, 1, 3, 9)
    values = [Decimal(text) for text in ("9.99", "10.00", "100.00", "100.01")]
    readings = table(
        spark, "meter_id bigint, measure decimal(8,2), datetime_measured timestamp_ntz", *[(1, v, office) for v in values]
    )
    owners = table(spark, "meter_id bigint, customer_type string", (1, "commercial"))
    assert {str(row.measure) for row in checks.out_of_range(readings, owners).collect()} == {"9.99", "100.01"}


@pytest.mark.parametrize("seed", range(3))
def test_missing_hours_against_brute_force(spark, seed):
    chance = random.Random(seed)
    first, last = datetime(2024, 2, 27, 5), datetime(2024, 3, 2, 21)
    hours = [first + timedelta(hours=n) for n in range(int((last - first).total_seconds() // 3600) + 1)]
    sent = [
        (meter, 1.0, at + timedelta(minutes=chance.randrange(60)))
        for meter in (1, 2, 3, 9)
        for at in hours
        if chance.random() < 0.6
        for _ in range(chance.choice((1, 1, 2)))
    ]
    sent += [(1, 1.0, first - timedelta(minutes=1)), (1, 1.0, last + timedelta(hours=1)), (2, 1.0, None), (None, 1.0, first)]
    readings = table(spark, "meter_id bigint, measure double, datetime_measured timestamp_ntz", *sent)
    meters = table(spark, "meter_id bigint", (1,), (2,), (3,), (4,), (4,))
    got = bag(checks.missing_hours(readings, meters, first, last))
    seen = {(meter, at.replace(minute=0)) for meter, _, at in sent if at is not None}
    assert got == Counter((meter, at) for meter in (1, 2, 3, 4) for at in hours if (meter, at) not in seen)


def test_missing_hours_refuses_a_backward_span(spark):
    with pytest.raises(ValueError):
        checks.missing_hours(spark.range(0), spark.range(0), datetime(2024, 1, 2), datetime(2024, 1, 1))


def test_places_of_meters(spark):
    known = seeds.provinces(spark)
    assert known.count() == 63
    assert checks.duplicate_keys(known, ["location"]).count() == checks.duplicate_keys(known, ["iso_code"]).count() == 0
    meters = table(spark, "meter_id bigint, location string", (1, "Kiên Giang"), (2, "Atlantis"), (3, None), (4, "Atlantis"))
    got = places.with_location(meters, known)
    assert bag(got, "meter_id", "iso_code", "latitude") == Counter(
        [(1, "VN-47", 9.825), (2, None, None), (3, None, None), (4, None, None)]
    )
    assert bag(places.unmatched_locations(meters, known)) == Counter([("Atlantis", 2)])


def test_dates_survive_as_dates(spark):
    rows = table(spark, "d date", (date(2024, 1, 1),), (date(2024, 1, 1),))
    assert bag(checks.duplicate_keys(rows, ["d"])) == Counter([(date(2024, 1, 1), 2)])
