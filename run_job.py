"""Submit one job of the pipeline: ``spark-submit run_job.py JOB --option value ...``.

Operational tables are parquet folders ``customer``, ``contract``, ``electric_meter`` and the three
price lists under ``--operational``. Streams read the queue at ``--servers`` and need Spark's Kafka connector.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from wattfold.operators import calendar
from wattfold.plans import jobs
from wattfold.settings import build_session
from wattfold.sources import queue, seeds
from wattfold.streaming import speed

# The operational table that feeds each dimension.
SOURCES = {"dim_customer": "customer", "dim_contract": "contract", "dim_electric_meter": "electric_meter"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="job", required=True)

    def command(name: str, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    days = command("calendar", "warehouse")
    days.add_argument("--first", type=date.fromisoformat, default=calendar.FIRST_DAY)
    days.add_argument("--last", type=date.fromisoformat, default=calendar.LAST_DAY)

    dimension = command("dimension", "warehouse", "operational", "version")
    dimension.add_argument("--name", choices=sorted(SOURCES), required=True)
    dimension.add_argument("--previous")
    dimension.add_argument("--today", type=date.fromisoformat, help="the day that rows without a date are given")

    bucketed = command("upsert", "warehouse", "operational")
    bucketed.add_argument("--name", choices=sorted(SOURCES), required=True)
    bucketed.add_argument("--today", type=date.fromisoformat, help="the day that rows without a date are given")
    reconciled = command("reconcile", "warehouse", "operational")
    reconciled.add_argument("--name", choices=sorted(SOURCES), required=True)
    reconciled.add_argument("--load", action="store_true", help="also load the rows that differ")
    tidied = command("tidy", "table")
    tidied.add_argument("--days", type=float, default=7, help="age of folders that may go")
    command("compact", "out")

    command("check", "operational")
    command("seed-prices", "operational")

    consumption = command("consumption", "warehouse", "operational", "landed")
    consumption.add_argument("--day", type=date.fromisoformat, required=True)
    consumption.add_argument("--measure-type", default="double", help="a decimal type makes sums exact")

    revenue = command("revenue", "warehouse", "operational", "version")
    revenue.add_argument("--year", type=int, required=True)
    revenue.add_argument("--month", type=int, required=True)

    command("views", "warehouse", "version")
    export = command("export", "landed", "out")
    export.add_argument("--per", choices=("hour", "day"), default="hour")
    command("publish", "landed", "servers", "topic")

    for name in ("speed", "landing"):
        stream = command(name, "servers", "topic", "out", "checkpoint")
        stream.add_argument("--interval", help="time between batches; without it the stream stops at the end")
        stream.add_argument("--max-per-batch", default="10000000", help="messages that one batch takes at most")
        if name == "landing":
            stream.add_argument("--zone", help="time zone of the landing day; the session's without it")
    return top


def run(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.job == "calendar":
        jobs.load_calendar(spark, given.warehouse, given.first, given.last)
    elif given.job in ("dimension", "upsert", "reconcile"):
        source = spark.read.parquet(f"{given.operational}/{SOURCES[given.name]}")
        if given.name == "dim_electric_meter":
            source, unknown = jobs.placed_meters(source, seeds.provinces(spark))
            print(f"{given.name}: {unknown} place names are unknown")
        if given.job == "upsert":
            print(f"{given.name}: {jobs.upsert_dimension(spark, source, given.warehouse, given.name, given.today)}")
            return
        if given.job == "reconcile":
            print(f"{given.name}: {jobs.reconcile_dimension(spark, source, given.warehouse, given.name, given.load)}")
            return
        left_out = jobs.load_dimension(
            spark, source, given.warehouse, given.name, given.version, given.previous, given.today
        )
        print(f"{given.name}: {left_out} source rows without a key were left out")
    elif given.job == "consumption":
        parties = [spark.read.parquet(f"{given.operational}/{name}") for name in SOURCES.values()]
        print(jobs.load_consumption(spark, given.landed, given.day, *parties, given.warehouse, given.measure_type))
    elif given.job == "check":
        parties = [spark.read.parquet(f"{given.operational}/{name}") for name in SOURCES.values()]
        print(jobs.check_operational(*parties))
    elif given.job == "seed-prices":
        jobs.seed_prices(spark, given.operational)
    elif given.job == "revenue":
        prices = jobs.read_prices(spark, given.operational)
        jobs.load_revenue(spark, given.warehouse, given.year, given.month, given.version, prices)
    elif given.job == "views":
        for name, periods in jobs.store_views(spark, given.warehouse, given.version).items():
            print(f"{name}: {len(periods)} periods written")
    elif given.job == "tidy":
        print(f"{jobs.tidy(spark, given.table, given.days)} folders removed")
    elif given.job == "compact":
        print(f"{speed.compact(spark, given.out)} merges")
    elif given.job == "export":
        jobs.export_readings(spark, given.landed, given.out, given.per)
    elif given.job == "publish":
        jobs.publish_readings(spark, given.landed, given.servers, given.topic)
    else:
        messages = queue.read_messages(spark, given.servers, given.topic, maxOffsetsPerTrigger=given.max_per_batch)
        if given.job == "speed":
            stream = jobs.start_speed_layer(messages, given.out, given.checkpoint, given.interval)
        else:
            stream = jobs.start_landing(messages, given.out, given.checkpoint, given.interval, zone=given.zone)
        stream.awaitTermination()


def main(arguments: Sequence[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    run(build_session(f"wattfold-{given.job}"), given)


if __name__ == "__main__":
    main()
