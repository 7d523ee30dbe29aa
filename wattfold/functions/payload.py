"""The one-line text form in which a reading travels through a queue."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the timestamp format of queue lines and of landed files.
MOMENT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def moment_text(moment: Column) -> Column:
    return F.date_format(moment, MOMENT_FORMAT)


def encode_reading(meter_id: Column, measure: Column, moment: Column) -> Column:
    """``meter_id,measure,yyyy-MM-dd HH:mm:ss``; a NULL becomes an empty field."""
    fields = (meter_id.cast("string"), measure.cast("string"), moment_text(moment))
    return F.concat_ws(",", *[F.coalesce(field, F.lit("")) for field in fields])


def decode_fields(
    meter_id: Column, measure: Column, moment: Column, measure_type: str = "double"
) -> tuple[Column, Column, Column]:
    """Typed columns of a reading's three texts; a bad or missing one becomes NULL and never fails the job."""
    return (
        meter_id.try_cast("bigint").alias("meter_id"),
        measure.try_cast(measure_type).alias("measure"),
        moment.try_cast("timestamp_ntz").alias("datetime_measured"),
    )


def decode_reading(line: Column) -> tuple[Column, Column, Column]:
    fields = F.split(line, ",")
    return decode_fields(*[F.get(fields, place) for place in range(3)])


def is_valid() -> Column:
    """Whether a decoded reading has all its fields and a finite measure; never NULL."""
    measure = F.col("measure").cast("double")
    finite = F.coalesce(~F.isnan(measure) & (F.abs(measure) != float("inf")), F.lit(False))
    return F.col("meter_id").isNotNull() & F.col("datetime_measured").isNotNull() & finite


def instant(moment: Column, zone: str) -> Column:
    """The instant of a wall-clock moment in ``zone``, whatever the session's zone is."""
    return F.concat(moment.cast("timestamp_ntz").cast("string"), F.lit(f" {zone}")).cast("timestamp")


def wall_clock(moment: Column, zone: str) -> Column:
    """What clocks in ``zone`` show at an instant, whatever the session's zone is."""
    return F.convert_timezone(None, F.lit(zone), moment.cast("timestamp").cast("timestamp_ntz"))
