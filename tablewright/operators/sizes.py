"""Broadcasting behind a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def broadcast_up_to(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the known row count is small, else leave the join to Spark."""
    return F.broadcast(df) if rows <= limit else df
