"""Broadcast hints that check the size of what they broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of ids or scores that a broadcast may hold (some tens of MB).
BROADCAST_ROWS = 500_000


def within(df: DataFrame, limit: int | None = None) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no more than that."""
    limit = BROADCAST_ROWS if limit is None else limit
    return df.limit(limit + 1).count() <= limit


def small_side(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows (counted,
    reading no more than that); otherwise as it is, and the join shuffles."""
    return F.broadcast(df) if within(df, limit) else df
