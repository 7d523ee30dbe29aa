"""Location codes and coordinates of meters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_location(meters: DataFrame, places: DataFrame) -> DataFrame:
    """Meters with the code and coordinates of their location; an unknown place leaves NULLs."""
    return meters.join(places.select("location", "iso_code", "latitude", "longitude"), "location", "left")


def unmatched_locations(meters: DataFrame, places: DataFrame) -> DataFrame:
    """Location names that the place table does not know, with the number of meters."""
    used = meters.where(F.col("location").isNotNull()).groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    return used.join(places.select("location"), "location", "left_anti")
