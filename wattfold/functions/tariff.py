"""Progressive (slab) tariff as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inclusive upper bounds in kWh of all slabs but the last, which is open.
SLAB_BOUNDS = (50, 100, 200, 300, 400)


def price_by_tier(prices: DataFrame) -> Column:
    """The slab prices in order of their tiers as one array, read through a scalar subquery.

    Spark runs the subquery once and hands its value to the tasks, so no price passes through
    Python. Any list but one price for each tier raises.
    """
    tiers = range(1, len(SLAB_BOUNDS) + 2)
    complete = F.count("*") == len(tiers)
    for tier in tiers:
        complete = complete & (F.count(F.when(F.col("tier") == tier, F.col("price"))) == 1)
    rates = F.array(*[F.max(F.when(F.col("tier") == tier, F.col("price"))) for tier in tiers])
    wrong = F.raise_error(F.lit(f"slab prices must be one for each tier from 1 to {len(tiers)}"))
    return prices.agg(F.when(complete, rates).otherwise(wrong).alias("rates")).scalar()


def slab_rates(by_tier: Column) -> list[Column]:
    """The price of each slab, by its tier number."""
    return [by_tier[F.lit(tier)] for tier in range(len(SLAB_BOUNDS) + 1)]


def slab_charge(usage: Column, rates: Sequence[Column]) -> Column:
    """Charge of a month's usage, one branch per slab.

    Usage below zero is charged at the first rate, and NULL stays NULL.
    """
    charge = F.when(usage <= SLAB_BOUNDS[0], usage * rates[0])
    below = SLAB_BOUNDS[0] * rates[0]
    for (lower, upper), rate in zip(pairwise(SLAB_BOUNDS), rates[1:]):
        charge = charge.when(usage <= upper, below + (usage - lower) * rate)
        below = below + (upper - lower) * rate
    return charge.otherwise(below + (usage - SLAB_BOUNDS[-1]) * rates[-1])


def slab_charge_by_parts(usage: Column, rates: Sequence[Column]) -> Column:
    """The same charge as a sum over slabs of (usage inside the slab) x (its rate)."""
    parts = F.least(usage, F.lit(SLAB_BOUNDS[0])) * rates[0]
    for (lower, upper), rate in zip(pairwise(SLAB_BOUNDS), rates[1:]):
        parts = parts + F.greatest(F.least(usage, F.lit(upper)) - lower, F.lit(0)) * rate
    parts = parts + F.greatest(usage - SLAB_BOUNDS[-1], F.lit(0)) * rates[-1]
    return F.when(usage.isNotNull(), parts)
