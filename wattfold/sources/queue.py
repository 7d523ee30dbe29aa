"""Queue source and sink. They need Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.functions import payload


def queue_options(servers: str, topic: str, starting: str = "earliest", **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **extra}


def read_messages(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """A stream of messages, of which the pipeline uses ``value`` (binary) and ``timestamp``."""
    return spark.readStream.format("kafka").options(**queue_options(servers, topic, **extra)).load()


def as_messages(readings: DataFrame) -> DataFrame:
    """Readings in message form; the meter is the message key, so a meter's readings stay in order."""
    line = payload.encode_reading(F.col("meter_id"), F.col("measure"), F.col("datetime_measured"))
    return readings.select(F.col("meter_id").cast("string").alias("key"), line.alias("value"))


def publish(readings: DataFrame, servers: str, topic: str) -> None:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    as_messages(readings).write.format("kafka").options(**options).save()
