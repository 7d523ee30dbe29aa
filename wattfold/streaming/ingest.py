"""Speed and landing layers: messages in, typed readings or landed files out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattfold import schemas
from wattfold.functions import payload
from wattfold.sinks import snapshots
from wattfold.streaming import speed

# Binary digits in which the delays of a bucket agree.
DELAY_BITS = 7

LINE_KEY = (*schemas.READING_COLUMNS, "raw")


def parse_messages(messages: DataFrame) -> DataFrame:
    """Typed readings from messages; ``valid`` is false, and ``raw`` kept, where a field is bad.

    Columns of the message other than its key and value pass through.
    """
    passed = [name for name in messages.columns if name not in ("key", "value")]
    line = F.col("value").cast("string")
    parsed = messages.select(*payload.decode_reading(line), line.alias("raw"), *passed)
    return parsed.withColumn("valid", payload.is_valid()).withColumn("raw", F.when(~F.col("valid"), F.col("raw")))


def drop_repeats(parsed: DataFrame, delay: str = "1 day", key: Sequence[str] = LINE_KEY) -> DataFrame:
    """Parsed messages with retransmissions removed that arrive within ``delay`` of each other.

    State is aged by the time at which a batch is processed, not by the measured instant, so
    a reading that comes late is never lost. The default key is the whole reading, so two
    different values for one instant both stay, and bad lines are told apart by their text.
    """
    seen = parsed.withColumn("seen_at", F.current_timestamp()).withWatermark("seen_at", delay)
    return seen.dropDuplicatesWithinWatermark(list(key)).drop("seen_at")


def _start(writer, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest(
    parsed: DataFrame, table: str, checkpoint: str, interval: str | None = None, compacted: bool = True,
    delay: str | None = None,
) -> StreamingQuery:
    """Append parsed readings to the speed-layer table, by measured day; bad rows are told by ``valid``.

    A batch repeated after a failure is there once. Batches are numbered per checkpoint, so a run has the
    checkpoint's name: a stream started afresh under a new name never touches what an older one
    wrote. With ``compacted``, small batches are merged on the way. With ``delay``, the time that
    ``drop_repeats`` remembers, readings measured longer ago are looked up in the table, so that repeats
    of any age are dropped. Clocks of meters may be a day off. Without ``interval`` the stream takes what
    is there and stops.
    """
    known_before = None
    if delay is not None:
        known_before = F.expr(f"cast(current_timestamp() - INTERVAL {delay} + INTERVAL 1 DAY AS TIMESTAMP_NTZ)")
    run = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def write(batch: DataFrame, batch_id: int) -> None:
        speed.append_batch(batch, table, run, batch_id, known_before)
        if compacted:
            speed.compact(batch.sparkSession, table, run)

    columns = [*schemas.READING_COLUMNS, "raw", "valid"]
    return _start(parsed.select(*columns).writeStream.foreachBatch(write), checkpoint, interval)


def read_speed_table(spark: SparkSession, table: str) -> DataFrame:
    return speed.read_speed_table(spark, table)


def land_csv(
    messages: DataFrame, folder: str, checkpoint: str, interval: str | None = None, zone: str | None = None
) -> StreamingQuery:
    """Land messages as CSV files with a header, one folder per day of arrival (``land_day``).

    The day is the one in ``zone``, or in the session's zone without it. The three fields of a line
    are landed as text, so that a bad one is still there to look at.
    """
    fields = F.split(F.col("value").cast("string"), ",")
    arrived = F.col("timestamp") if zone is None else payload.wall_clock(F.col("timestamp"), zone)
    rows = messages.select(
        *[F.get(fields, place).alias(name) for place, name in enumerate(schemas.READING_COLUMNS)],
        F.date_format(arrived, "yyyyMMdd").alias("land_day"),
    )
    writer = rows.writeStream.format("csv").option("header", True).option("path", folder).partitionBy("land_day")
    return _start(writer, checkpoint, interval)


def ingest_delay(parsed: DataFrame, arrived: Column | None = None, zone: str | None = None) -> DataFrame:
    """Milliseconds from the measured instant to arrival, per reading.

    ``arrived`` defaults to the time at which the batch is processed; pass the message's own
    ``timestamp`` to measure only the way into the queue. Meters' clocks run in ``zone``; without it,
    in the session's zone.
    """
    arrived = F.current_timestamp() if arrived is None else arrived
    moment = F.col("datetime_measured")
    measured = moment.cast("timestamp") if zone is None else payload.instant(moment, zone)
    delay = F.unix_millis(arrived.cast("timestamp")) - F.unix_millis(measured)
    return parsed.where(F.col("valid")).withColumn("delay_ms", delay)


def delay_histogram(delays: DataFrame) -> DataFrame:
    """``day, bucket_ms, readings, sum_ms, max_ms``: delays counted by day and size; histograms are added up by
    ``merge_histograms``.

    A bucket holds the delays that agree in their first ``DELAY_BITS`` binary digits, and is named by the least of
    them in size, which is less than one part in 2^(DELAY_BITS - 1) below any. So a day has a few thousand
    buckets at most, however many readings it has.
    """
    size = F.abs("delay_ms")
    shift = F.greatest(F.length(F.bin(size)) - DELAY_BITS, F.lit(0))
    low = F.expr("shiftleft(shiftright(__size, __shift), __shift)") * F.signum("delay_ms").cast("long")
    rows = delays.withColumns({"day": F.col("datetime_measured").cast("date"), "__size": size, "__shift": shift})
    return rows.groupBy("day", low.alias("bucket_ms")).agg(
        F.count(F.lit(1)).alias("readings"), F.sum("delay_ms").alias("sum_ms"), F.max("delay_ms").alias("max_ms")
    )


def merge_histograms(histograms: DataFrame) -> DataFrame:
    """The histogram of all that were counted apart, such as a stream's batches."""
    return histograms.groupBy("day", "bucket_ms").agg(
        F.sum("readings").alias("readings"), F.sum("sum_ms").alias("sum_ms"), F.max("max_ms").alias("max_ms")
    )


def histogram_report(histogram: DataFrame) -> DataFrame:
    """Per day: readings, mean and worst delay (exact), and its median and 95th percentile by their buckets."""
    so_far = Window.partitionBy("day").orderBy("bucket_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = histogram.withColumns(
        {"below": F.sum("readings").over(so_far), "all_of": F.sum("readings").over(Window.partitionBy("day"))}
    )

    def percentile(percent: int) -> Column:
        reached = F.expr(f"below >= ({percent} * all_of + 99) div 100")
        return F.min(F.when(reached, F.col("bucket_ms")))

    return counted.groupBy("day").agg(
        F.sum("readings").alias("readings"),
        (F.sum("sum_ms") / F.sum("readings")).alias("mean_ms"),
        F.max("max_ms").alias("max_ms"),
        percentile(50).alias("p50_ms"),
        percentile(95).alias("p95_ms"),
    )


def delay_report(delays: DataFrame) -> DataFrame:
    """Per day: readings, mean and worst delay, and its median and 95th percentile to one part in 64."""
    return histogram_report(delay_histogram(delays))


def count_delays(delays: DataFrame, table: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Keep the histogram of a stream of delays, a slice per batch; a batch repeated after a failure replaces its own."""
    run = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def write(batch: DataFrame, batch_id: int) -> None:
        snapshots.replace_slice(delay_histogram(batch), table, "batch", f"{run}-{batch_id}", "day")

    return _start(delays.writeStream.foreachBatch(write), checkpoint, interval)
