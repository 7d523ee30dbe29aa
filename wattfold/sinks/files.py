"""File sinks beside those of ``snapshots``. All of them can be run again without doubling rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.functions.payload import moment_text


def write_version(table: DataFrame, base: str, version: str) -> None:
    """Write a new version of a table beside the one it may have been read from.

    Readers switch by naming the new version, and a load that fails halfway is run again
    into the same place.
    """
    table.write.mode("overwrite").parquet(f"{base}/version={version}")


def read_version(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{base}/version={version}")


# Folder column and stamp pattern of the two ways to cut reading files.
CUTS = {"hour": ("hour_stamp", "yyyyMMddHH", "0000"), "day": ("land_day", "yyyyMMdd", "")}


def write_readings_csv(readings: DataFrame, path: str, per: str = "hour") -> None:
    """Reading files with a header, one folder per hour or day, named by its stamp.

    An hour that holds a third of the rows is split over several files.
    """
    folder, pattern, rest = CUTS[per]
    moment = F.col("datetime_measured")
    stamp = F.concat(F.date_format(moment, pattern), F.lit(rest)).alias(folder)
    rows = readings.select("meter_id", "measure", moment_text(moment).alias("datetime_measured"), stamp)
    rows.hint("rebalance", folder).write.mode("overwrite").partitionBy(folder).csv(path, header=True)
