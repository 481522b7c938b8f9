"""Broadcasts behind a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def is_small(rows: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether there are at most ``most`` rows. Counts them, so they should be written already."""
    return rows.limit(most + 1).count() <= most


def small(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Narrow rows with a broadcast hint if there are at most ``most``; more are joined by a shuffle."""
    return F.broadcast(rows) if is_small(rows, most) else rows
