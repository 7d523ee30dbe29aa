"""The nine roll-ups as stored tables that follow the facts.

A stored roll-up is cut by period and remembers which slices of its fact it was made of. When a landing
day or a month was loaded since, the periods that the old and the new slice have are read again from
all slices that have them, summed, and put in place of what was there, in one step. Other periods are
neither read nor written. With another version of the dimensions everything is made again, since names
and places stand in the roll-ups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.operators import rollups
from wattfold.sinks import files as sinks
from wattfold.sinks import snapshots
from wattfold.sinks.snapshots import Snapshot

FACTS = {"consumption": "fact_power_consumption", "revenue": "fact_revenue"}
# The fact that each roll-up sums, and the column of its fact that its periods come from.
MEASURES = {
    "daily_total_consumption": "consumption",
    "daily_consumption_by_customer": "consumption",
    "daily_consumption_by_customer_type": "consumption",
    "daily_consumption_by_location": "consumption",
    "daily_consumption_by_meter": "consumption",
    "daily_consumption_by_time_of_day": "consumption",
    "monthly_total_revenue": "revenue",
    "monthly_revenue_by_customer": "revenue",
    "monthly_revenue_by_customer_type": "revenue",
}


def _periods(name: str, parts: list[str] | tuple[str, ...]) -> set[str]:
    """The periods of a slice: its parts are days; a slice of bills is named by its month's first day."""
    return {name.split("=", 1)[1]} if name.startswith("date_id=") else set(parts)


def changed_periods(fact: Snapshot, sources: dict[str, list]) -> set[str]:
    """Periods in slices that came, went or were replaced since a roll-up was made of ``sources``."""
    now = {name: [part.folder, list(part.parts)] for name, part in fact.slices.items()}
    names = [name for name in now.keys() | sources.keys() if now.get(name) != sources.get(name)]
    return {
        period for name in names for state in (now, sources) if name in state for period in _periods(name, state[name][1])
    }


def refresh(
    spark: SparkSession, table: str, view: str, fact_table: str, days: DataFrame, customers: DataFrame, meters: DataFrame,
    dimensions: str,
) -> set[str]:
    """Bring one stored roll-up up to its fact; the periods (``date_id``) that were written.

    ``dimensions`` names what customers and meters are read from. The fact's snapshot is taken once, so what the
    roll-up holds and what it remembers agree even if a load publishes meanwhile.
    """
    fact = snapshots.current(spark, fact_table)
    before = snapshots.current(spark, table)
    same = before.notes.get("dimensions") == dimensions
    touched = changed_periods(fact, before.notes.get("sources", {}) if same else {})
    if not same:
        touched |= {name.split("=", 1)[1] for name in before.slices}
    if not touched:
        return touched
    measure = MEASURES[view]
    read = [name for name, part in fact.slices.items() if _periods(name, part.parts) & touched]
    # Of consumption only the touched days' folders are listed; a slice of bills is a month as a whole.
    cut = ("date_id", touched) if measure == "consumption" and same else None
    rows = snapshots.read(spark, fact_table, read, fact, cut)
    rows = rows.select(*[name for name in rows.columns if name not in ("land_day", "customer_type")])
    period = rollups.DAY if measure == "consumption" else rollups.MONTH
    summed = _rollup(view, rows, days, customers, meters)
    day = F.col("day") if "day" in period else F.lit(1)
    summed = summed.withColumn("date_id", (F.col("year") * 10000 + F.col("month") * 100 + day).cast("int"))
    sources = {name: [part.folder, list(part.parts)] for name, part in fact.slices.items()}
    snapshots.replace_parts(summed, table, "date_id", sorted(touched), {"sources": sources, "dimensions": dimensions})
    return touched


def _rollup(view: str, rows: DataFrame, days: DataFrame, customers: DataFrame, meters: DataFrame) -> DataFrame:
    empty = rows.limit(0)
    facts = (rows, empty.withColumn("revenue", F.lit(0.0))) if MEASURES[view] == "consumption" else (
        empty.withColumns({"consumption": F.lit(0.0), "time_of_day": F.lit("")}), rows)
    return rollups.all_rollups(*facts, days, customers, meters)[view]


def refresh_views(spark: SparkSession, warehouse: str, version: str) -> dict[str, set[str]]:
    """Bring the nine stored roll-ups under ``views`` up to the facts; the periods written of each.

    A roll-up whose fact has no slice yet is left out.
    """
    days = spark.read.parquet(f"{warehouse}/dim_date")
    customers = sinks.read_version(spark, f"{warehouse}/dim_customer", version)
    meters = sinks.read_version(spark, f"{warehouse}/dim_electric_meter", version)
    written = {}
    for view, measure in MEASURES.items():
        fact = f"{warehouse}/{FACTS[measure]}"
        if snapshots.current(spark, fact).slices:
            written[view] = refresh(spark, f"{warehouse}/views/{view}", view, fact, days, customers, meters, version)
    return written


def read_view(spark: SparkSession, warehouse: str, view: str) -> DataFrame:
    """A stored roll-up."""
    return snapshots.read(spark, f"{warehouse}/views/{view}").drop("date_id")
