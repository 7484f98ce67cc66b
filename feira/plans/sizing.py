"""Broadcast only what was counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows of a few columns; far above any calendar, far below any executor's memory
BROADCAST_ROWS = 200_000


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``max_rows`` rows, else as it is.

    The count stops at the bound. A larger frame is joined the way the planner
    picks, with its handling of skewed partitions.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
