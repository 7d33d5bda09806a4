"""Size checks that gate broadcasts.

A broadcast copies a table to every executor, so it is only safe for a side
with a proven bound.  ``broadcast_if_small`` proves it by counting at most
``max_rows + 1`` rows (a bounded scan: ``limit`` stops early) and otherwise
leaves the join to the planner, which shuffles both sides (and AQE may still
pick a broadcast from runtime statistics under its own byte threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_count(df: DataFrame, max_rows: int) -> int:
    """Row count of ``df`` capped at ``max_rows + 1`` (enough to test the bound)."""
    return df.limit(max_rows + 1).count()


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df`` unchanged."""
    return F.broadcast(df) if bounded_count(df, max_rows) <= max_rows else df
