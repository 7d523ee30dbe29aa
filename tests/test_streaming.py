import os
import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from rows import bag, table

from wattfold import schemas
from wattfold.sinks import snapshots
from wattfold.sources import files
from wattfold.streaming import ingest

START = datetime(2024, 1, 1)
MESSAGE = "value binary, timestamp timestamp_ntz"


class Topic:
    """A folder of message files that a stream reads file by file."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.path = spark, folder, f"{folder}/topic"

    def send(self, *lines):
        rows = [(line.encode(), START + timedelta(minutes=n)) for n, line in enumerate(lines)]
        table(self.spark, MESSAGE, *rows).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        reader = self.spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1)
        return reader.parquet(self.path)

    def ingest(self, dedup=False):
        parsed = ingest.parse_messages(self.stream())
        if dedup:
            parsed = ingest.drop_repeats(parsed)
        ingest.ingest(parsed, f"{self.folder}/table", f"{self.folder}/checkpoint").awaitTermination()

    def table(self):
        return ingest.read_speed_table(self.spark, f"{self.folder}/table")


def reading(n, meter=1):
    at = START + timedelta(hours=n)
    return f"{meter},{n + 0.5},{at}", (meter, n + 0.5, at)


def test_stream_equals_batch_and_a_restart_adds_only_what_is_new(spark, folder):
    topic = Topic(spark, folder)
    sent = [reading(n) for n in range(6)]
    topic.send(*[line for line, _ in sent[:3]])
    topic.send(*[line for line, _ in sent[3:5]])
    topic.ingest()
    first = bag(topic.table(), *schemas.READING_COLUMNS)
    assert first == Counter(row for _, row in sent[:5])
    topic.ingest()
    assert bag(topic.table(), *schemas.READING_COLUMNS) == first
    topic.send(sent[5][0])
    topic.ingest()
    assert bag(topic.table(), *schemas.READING_COLUMNS) == Counter(row for _, row in sent)
    batch = ingest.parse_messages(spark.read.schema(MESSAGE).parquet(topic.path))
    assert bag(batch, *schemas.READING_COLUMNS) == Counter(row for _, row in sent)


def test_a_batch_repeated_after_a_failure_replaces_itself(spark, folder):
    topic = Topic(spark, folder)
    topic.send(*[reading(n)[0] for n in range(2)])
    topic.send(*[reading(n)[0] for n in range(2, 4)])
    topic.ingest()
    before = bag(topic.table(), *schemas.READING_COLUMNS)
    # The state after a crash between the write of the last batch and its commit.
    for name in ("1", ".1.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    topic.ingest()
    assert os.path.exists(f"{folder}/checkpoint/commits/1")
    assert bag(topic.table(), *schemas.READING_COLUMNS) == before


def test_a_new_checkpoint_leaves_older_batches_alone(spark, folder):
    topic = Topic(spark, folder)
    topic.send(reading(0)[0])
    topic.ingest()
    other = Topic(spark, f"{folder}/other")
    other.send(reading(1)[0])
    parsed = ingest.parse_messages(other.stream())
    ingest.ingest(parsed, f"{folder}/table", f"{folder}/checkpoint-2").awaitTermination()
    assert bag(topic.table(), *schemas.READING_COLUMNS) == Counter([reading(0)[1], reading(1)[1]])


def test_bad_lines_are_kept_apart_with_their_text(spark, folder):
    topic = Topic(spark, folder)
    good, row = reading(0)
    topic.send(good, "bad,1.0,2024-01-01 00:00:00", "7,1.0", "")
    topic.ingest()
    assert bag(topic.table().where("valid"), *schemas.READING_COLUMNS, "raw") == Counter([(*row, None)])
    assert bag(topic.table().where("NOT valid"), "raw") == Counter([("bad,1.0,2024-01-01 00:00:00",), ("7,1.0",), ("",)])


def test_repeats_are_dropped_across_batches_and_restarts(spark, folder):
    topic = Topic(spark, folder)
    sent = [reading(n) for n in range(4)]
    lines = [line for line, _ in sent]
    topic.send(*lines, *lines)
    topic.send(lines[3], lines[2])
    topic.ingest(dedup=True)
    topic.send(lines[3])
    topic.ingest(dedup=True)
    assert bag(topic.table(), *schemas.READING_COLUMNS) == Counter(row for _, row in sent)


def test_a_stream_started_afresh_drops_what_the_table_has(spark, folder):
    topic = Topic(spark, folder)
    sent = [reading(n) for n in range(30)]
    topic.send(*[line for line, _ in sent], "bad")
    for checkpoint in ("first", "second"):
        parsed = ingest.drop_repeats(ingest.parse_messages(topic.stream()))
        ingest.ingest(parsed, f"{folder}/table", f"{folder}/{checkpoint}", delay="1 day").awaitTermination()
        topic.send(sent[3][0], sent[29][0])
    assert bag(topic.table().where("valid"), *schemas.READING_COLUMNS) == Counter(row for _, row in sent)
    assert topic.table().where("NOT valid").count() == 1


def test_a_late_reading_is_kept(spark, folder):
    topic = Topic(spark, folder)
    late, row = reading(-24 * 60)
    topic.send(reading(0)[0], reading(1)[0])
    topic.ingest(dedup=True)
    topic.send(reading(48)[0])
    topic.ingest(dedup=True)
    topic.send(late, late)
    topic.ingest(dedup=True)
    assert bag(topic.table().where("datetime_measured < '2024-01-01'"), *schemas.READING_COLUMNS) == Counter([row])


def test_bad_lines_survive_de_duplication(spark, folder):
    topic = Topic(spark, folder)
    topic.send("bad", "bad", "worse", reading(0)[0], "x,1.0,2024-01-01 00:00:00")
    topic.ingest(dedup=True)
    assert bag(topic.table().where("NOT valid"), "raw") == Counter([("bad",), ("worse",), ("x,1.0,2024-01-01 00:00:00",)])
    assert topic.table().where("valid").count() == 1


def test_two_values_for_one_instant_both_stay(spark, folder):
    topic = Topic(spark, folder)
    topic.send("1,1.0,2024-01-01 00:00:00", "1,2.0,2024-01-01 00:00:00", "1,2.0,2024-01-01 00:00:00")
    topic.ingest(dedup=True)
    assert bag(topic.table(), "measure") == Counter([(1.0,), (2.0,)])


def test_landed_files_have_a_header_and_one_folder_per_day(spark, folder):
    topic = Topic(spark, folder)
    sent = [reading(n) for n in range(3)]
    topic.send(*[line for line, _ in sent[:2]], sent[2][0] + ",more", "oops")
    ingest.land_csv(topic.stream(), f"{folder}/files", f"{folder}/land-checkpoint").awaitTermination()
    got = files.read_readings(spark, f"{folder}/files")
    assert bag(got, *schemas.READING_COLUMNS) == Counter([row for _, row in sent] + [(None, None, None)])
    text = spark.read.text(f"{folder}/files/land_day=20240101")
    assert text.where(F.col("value") == "meter_id,measure,datetime_measured").count() >= 1


def test_delay_of_valid_readings(spark, folder):
    rows = [(b"1,1.0,2024-01-01 00:00:00", START + timedelta(milliseconds=250)), (b"x", START)]
    parsed = ingest.parse_messages(table(spark, MESSAGE, *rows))
    report = ingest.delay_report(ingest.ingest_delay(parsed, F.col("timestamp"))).collect()
    assert [tuple(row) for row in report] == [(START.date(), 1, 250.0, 250, 250, 250)]
    assert ingest.ingest_delay(parsed).first().delay_ms > 0


def test_percentiles_of_added_histograms_are_near_the_exact_ones(spark):
    rnd = random.Random(9)
    sizes = [int(rnd.lognormvariate(6, 2)) for _ in range(4000)] + [-5, -300, 0]
    rows = [(START + timedelta(days=n % 2), size) for n, size in enumerate(sizes)]
    delays = table(spark, "datetime_measured timestamp_ntz, delay_ms bigint", *rows)
    parts = [ingest.delay_histogram(delays.where(F.pmod("delay_ms", F.lit(3)) == n)) for n in range(3)]
    merged = ingest.merge_histograms(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    report = {row.day: row for row in ingest.histogram_report(merged).collect()}
    assert bag(ingest.delay_report(delays)) == bag(ingest.histogram_report(merged))
    for day in range(2):
        exact = sorted(size for at, size in rows if at.day == START.day + day)
        row = report[(START + timedelta(days=day)).date()]
        assert (row.readings, row.max_ms) == (len(exact), exact[-1]) and abs(row.mean_ms - sum(exact) / len(exact)) < 1e-6
        for percent, found in ((50, row.p50_ms), (95, row.p95_ms)):
            true = exact[-(-percent * len(exact) // 100) - 1]
            assert found <= true < found * (1 + 1 / 64) + 1
    assert merged.groupBy("day").count().agg(F.max("count")).first()[0] < 2000


def test_delays_are_counted_once_over_batches_and_failures(spark, folder):
    topic = Topic(spark, folder)
    for n in range(3):
        topic.send(reading(n)[0], reading(n + 10)[0])

    def count():
        delays = ingest.ingest_delay(ingest.parse_messages(topic.stream()), F.col("timestamp"))
        ingest.count_delays(delays, f"{folder}/delays", f"{folder}/delays-checkpoint").awaitTermination()
        merged = ingest.merge_histograms(snapshots.read(spark, f"{folder}/delays"))
        return ingest.histogram_report(merged).agg(F.sum("readings")).first()[0]

    assert count() == 6
    for name in ("2", ".2.crc"):
        os.remove(f"{folder}/delays-checkpoint/commits/{name}")
    assert count() == 6
