"""Broadcast a join side only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Configuration tables (rules, prices, labels, subscriptions) are far below this.
MAX_BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df`` (the planner and
    AQE then pick a shuffle join). The count reads at most ``max_rows + 1`` rows."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
