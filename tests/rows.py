"""Small tables from literals, and comparisons that ignore row order."""

from __future__ import annotations

from collections import Counter


def table(spark, schema: str, *rows):
    return spark.createDataFrame(list(rows), schema)


def bag(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return Counter(tuple(row) for row in picked.collect())


def only(frame):
    (row,) = frame.collect()
    return row
