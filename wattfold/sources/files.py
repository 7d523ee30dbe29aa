"""File sources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold import schemas


def read_readings(spark: SparkSession, path_glob: str) -> DataFrame:
    """Landed reading files with a header; the glob picks landing days. A bad field reads as NULL."""
    return spark.read.schema(schemas.READING).csv(path_glob, header=True)


def read_reading_texts(spark: SparkSession, path_glob: str) -> DataFrame:
    """The same files with every field as the text that was landed."""
    texts = ", ".join(f"{name} STRING" for name in schemas.READING_COLUMNS)
    return spark.read.schema(texts).csv(path_glob, header=True)


def read_landed_texts(spark: SparkSession, folder: str, land_day: date) -> DataFrame:
    """One landing day, as texts, out of the folder that the landing stream writes.

    The folder is read as a whole and pruned by partition, because only so does Spark leave
    out files of batches that were never committed.
    """
    day = F.col("land_day") == int(land_day.strftime("%Y%m%d"))
    return read_reading_texts(spark, folder).where(day).drop("land_day")


def read_meter_list(spark: SparkSession, path: str) -> DataFrame:
    """Meter and contract ids from a CSV export, columns found by header name."""
    listed = spark.read.csv(path, header=True)
    return listed.select(*[listed[name].try_cast("bigint").alias(name) for name in ("meter_id", "contract_id")])


def read_table(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")
