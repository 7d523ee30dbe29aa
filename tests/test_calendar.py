from datetime import date, datetime, timedelta

import pytest
from rows import table

from wattfold.operators import calendar


def test_default_calendar_covers_both_ends(spark):
    days = calendar.calendar(spark)
    rows = {row.date: row for row in days.collect()}
    assert days.columns == ["date_id", "date", "day", "month", "year", "quarter"]
    assert len(rows) == 732 and min(rows) == date(2023, 1, 1) and max(rows) == date(2025, 1, 1)
    day = date(2023, 1, 1)
    while day <= date(2025, 1, 1):
        want = (int(day.strftime("%Y%m%d")), day, day.day, day.month, day.year, (day.month - 1) // 3 + 1)
        assert tuple(rows[day]) == want
        day += timedelta(days=1)


def test_calendar_of_one_day_and_of_none(spark):
    assert calendar.calendar(spark, date(2024, 2, 29), date(2024, 2, 29)).first().date_id == 20240229
    with pytest.raises(ValueError):
        calendar.calendar(spark, date(2024, 2, 29), date(2024, 2, 28))


def test_calendar_spanning_a_column(spark):
    rows = table(spark, "at timestamp_ntz", (datetime(2024, 2, 28, 23),), (None,), (datetime(2024, 3, 1, 0),))
    got = [row.date_id for row in calendar.calendar_spanning(rows, "at").orderBy("date_id").collect()]
    assert got == [20240228, 20240229, 20240301]


def test_a_wrong_date_does_not_stretch_a_bounded_calendar(spark):
    days = [datetime(1900, 1, 1), datetime(2024, 2, 28, 23), None, datetime(2024, 3, 1, 23), datetime(9999, 1, 1)]
    rows = table(spark, "at timestamp_ntz", *[(day,) for day in days])
    bounds = date(2024, 1, 1), date(2024, 3, 1)
    spanned = calendar.calendar_spanning(rows, "at", *bounds)
    assert sorted(row.date_id for row in spanned.collect()) == [20240228, 20240229, 20240301]
    assert calendar.outside(rows, "at", *bounds) == 2 and calendar.outside(rows, "at") == 0
    assert calendar.calendar_spanning(rows, "at", date(9999, 12, 31)).isEmpty()
