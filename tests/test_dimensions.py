from collections import Counter
from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from rows import bag, only, table

from wattfold.operators import dimensions
from wattfold.plans.testbed import Testbed
from wattfold.sinks import files as sinks

CUSTOMER = (
    "customer_id bigint, customer_name string, phone string, email string, address string, customer_type string, "
    "updated_date date"
)
CONTRACT = "contract_id bigint, date_created date, status string, updated_date date"
METER = (
    "meter_id bigint, meter_type string, voltage string, status string, location string, latitude double, "
    "longitude double, iso_code string, updated_date date"
)


def june(day):
    return date(2024, 6, day)


def test_customer_golden(spark):
    contact = ("123-456-7890", "john@example.com", "123 Main St", "Residential")
    other = ("987-654-3210", "jane@example.com", "456 Elm St", "Residential")
    source = table(spark, CUSTOMER, (1, "John Doe 1", *contact, june(15)), (2, "Jane Smith", *other, june(16)))
    target = table(spark, CUSTOMER, (1, "John Doe", *contact, june(14)))
    got = dimensions.upsert(source, target, dimensions.CUSTOMER)
    assert bag(got) == bag(source)


def test_contract_golden_drops_the_customer(spark):
    source = table(
        spark,
        "contract_id bigint, customer_id bigint, date_created date, status string, updated_date date",
        (1, 1, june(15), "active", june(15)),
        (2, 2, june(15), "active", june(15)),
    )
    target = table(spark, CONTRACT, (1, june(14), "active", june(14)))
    got = dimensions.upsert(source, target, dimensions.CONTRACT)
    assert got.columns == ["contract_id", "date_created", "status", "updated_date"]
    assert bag(got) == Counter([(n, june(15), "active", june(15)) for n in (1, 2)])


def test_meter_golden_drops_the_contract(spark):
    body = ("single-phase", None, "active")
    place = (9.825, 105.1259, "VN-47")
    source = table(
        spark,
        "contract_id bigint, " + METER,
        (48, 236, *body, "Kiên Giang1", *place, june(15)),
        (48, 237, *body, "Kiên Giang", *place, june(16)),
    )
    target = table(spark, METER, (236, *body, "Kiên Giang", *place, june(14)))
    got = dimensions.upsert(source, target, dimensions.METER)
    assert "contract_id" not in got.columns
    assert bag(got, "meter_id", "location") == Counter([(236, "Kiên Giang1"), (237, "Kiên Giang")])


def contracts(spark, *rows):
    return table(spark, CONTRACT, *[(key, june(1), status, day) for key, status, day in rows])


def test_the_watermark_day_itself_is_skipped_unless_asked_for(spark):
    target = contracts(spark, (1, "old", june(10)), (2, "old", june(9)))
    source = contracts(spark, (1, "new", june(10)), (2, "new", june(11)), (3, "new", june(10)), (4, "new", june(9)), (5, "new", None))
    strict = bag(dimensions.upsert(source, target, dimensions.CONTRACT), "contract_id", "status")
    assert strict == Counter([(1, "old"), (2, "new")])
    wide = bag(dimensions.upsert(source, target, dimensions.CONTRACT, inclusive=True), "contract_id", "status")
    assert wide == Counter([(1, "new"), (2, "new"), (3, "new")])


def test_an_empty_target_takes_everything_dated(spark):
    target = contracts(spark, (1, "x", june(1))).limit(0)
    source = contracts(spark, (1, "new", june(1)), (2, "new", date(1900, 1, 1)), (3, "new", None))
    assert only(dimensions.watermark(target)).watermark == date(1900, 1, 1)
    assert bag(dimensions.upsert(source, target, dimensions.CONTRACT), "contract_id") == Counter([(1,)])


def test_null_keys_are_left_out_and_counted(spark):
    target = contracts(spark, (1, "old", june(1)))
    source = contracts(spark, (None, "new", june(2)), (None, "new", june(3)), (2, "new", june(2)))
    seen = Observation()
    got = dimensions.fresh_rows(source, target, dimensions.CONTRACT, null_keys=seen)
    assert bag(got, "contract_id") == Counter([(2,)])
    assert seen.get["null_keys"] == 2
    assert bag(dimensions.upsert(source, target, dimensions.CONTRACT), "contract_id") == Counter([(1,), (2,)])


def test_of_several_new_rows_the_newest_counts(spark):
    target = contracts(spark, (1, "old", june(1)))
    source = contracts(spark, *[(1, f"v{day}", june(day)) for day in (4, 7, 5, 2)], (1, "v7b", june(7)))
    got = only(dimensions.upsert(source, target, dimensions.CONTRACT))
    assert (got.status, got.updated_date) == ("v7b", june(7))


def test_loading_twice_changes_nothing(spark, small):
    bed = Testbed(spark, small)
    once = dimensions.upsert(bed.contract_source(), bed.contract_target(), dimensions.CONTRACT)
    twice = dimensions.upsert(bed.contract_source(), once, dimensions.CONTRACT)
    assert bag(once) == bag(twice)


def test_slice_splits_into_changed_and_new(spark, small):
    bed = Testbed(spark, small)
    target = bed.customer_target()
    fresh = dimensions.incremental_slice(bed.customer_source(), target, dimensions.CUSTOMER)
    changed = dimensions.changed_keys(fresh, target, dimensions.CUSTOMER)
    new = dimensions.new_keys(fresh, target, dimensions.CUSTOMER)
    assert bag(changed) + bag(new) == bag(fresh)
    assert changed.count() > 0 and new.count() > 0


def test_a_version_is_written_beside_the_one_it_was_read_from(spark, folder):
    base = f"{folder}/dim_contract"
    sinks.write_version(contracts(spark, (1, "old", june(1))), base, "a")
    loaded = sinks.read_version(spark, base, "a")
    sinks.write_version(dimensions.upsert(contracts(spark, (2, "new", june(2))), loaded, dimensions.CONTRACT), base, "b")
    assert bag(sinks.read_version(spark, base, "b"), "contract_id") == Counter([(1,), (2,)])
    assert bag(sinks.read_version(spark, base, "a"), "contract_id") == Counter([(1,)])


def test_missing_dates_get_the_given_day(spark):
    got = dimensions.with_default_date(contracts(spark, (1, "a", None), (2, "a", june(2))), june(9))
    assert bag(got, "contract_id", "updated_date") == Counter([(1, june(9)), (2, june(2))])


def test_contracts_carry_the_customer_number(spark):
    got = only(dimensions.contracts_for_customers(table(spark, "customer_id bigint", (7,))))
    assert tuple(got) == (7, 7, date(2023, 1, 2), "active")


@pytest.mark.parametrize("contract, count, kind", [(1, 1, "single-phase"), (10000, 1, "single-phase"), (10001, 5, "three-phase")])
def test_meter_numbers_leave_room_for_five(spark, contract, count, kind):
    got = dimensions.meters_for_contracts(table(spark, "contract_id bigint", (contract,)), F.lit(count))
    want = Counter(((contract - 1) * 5 + k, contract, kind) for k in range(1, count + 1))
    assert bag(got, "meter_id", "contract_id", "meter_type") == want
