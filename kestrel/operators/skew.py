"""Joins of raw rows with a one-row-per-key table, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000  # a key is hot from 1/HOT_SHARE of all rows
HOT_ROWS = 100_000  # and from this many


def hot_key_join(rows: DataFrame, keyed: DataFrame, on: list[str], count: str,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (one row per key, ``count`` =
    its number of rows).  Keys with more than ``hot_rows`` and more than
    1/HOT_SHARE of all rows are broadcast -- fewer than HOT_SHARE of them
    can exist -- so their rows stay where they are; the rest is shuffled.
    One small job over ``keyed`` decides; without hot keys it is a plain
    join."""
    s = keyed.agg(F.max(count).alias("m"), F.sum(count).alias("n")).first()
    limit = max(hot_rows, (s["n"] or 0) / HOT_SHARE)
    if not s["m"] or s["m"] <= limit:
        return rows.join(keyed.drop(count), on)
    hot = keyed.where(F.col(count) > limit).drop(count)
    cold = keyed.where(F.col(count) <= limit).drop(count)
    by_hot = rows.join(F.broadcast(hot), on)  # < HOT_SHARE rows
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return by_hot.unionByName(rest)
