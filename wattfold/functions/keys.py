"""Date keys and time-of-use bands, as column expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The hours of day in each time-of-use band; all others are 'normal'.
HIGH_HOURS = (10, 11, 18, 19, 20)
LOW_HOURS = (23, 0, 1, 2, 3, 4)
BANDS = ("normal", "low", "high")


def date_id(moment: Column) -> Column:
    """``yyyyMMdd`` as INT, by arithmetic so that no text is built per reading."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def month_id(year: Column, month: Column) -> Column:
    """Date key of the first day of the month."""
    return year * 10000 + month * 100 + 1


def band_code(moment: Column) -> Column:
    """Time-of-use band as a byte, the place of its name in ``BANDS``; a NULL moment is 'normal'."""
    hour = F.hour(moment)
    code = F.when(hour.isin(*HIGH_HOURS), BANDS.index("high")).when(hour.isin(*LOW_HOURS), BANDS.index("low"))
    return code.otherwise(BANDS.index("normal")).cast("tinyint")


def band_name(code: Column) -> Column:
    low = F.when(code == BANDS.index("low"), "low")
    return low.when(code == BANDS.index("high"), "high").otherwise("normal")


def time_of_day(moment: Column) -> Column:
    """Name of the time-of-use band."""
    return band_name(band_code(moment))


def month_bounds(year: int, month: int) -> tuple[int, int]:
    """First and last possible date key of a month, for a range filter that prunes files."""
    if not 1 <= month <= 12:
        raise ValueError(f"month must be 1..12, got {month}")
    first = year * 10000 + month * 100
    return first + 1, first + 31


def moment_literal(moment: datetime) -> Column:
    """A wall-clock literal that no session or machine time zone can shift."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
