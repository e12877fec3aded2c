"""Join helpers: a size-checked broadcast for dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only after checking it holds at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows.  Beyond the bound the
    frame is returned unhinted and the planner shuffles (or AQE broadcasts
    at runtime if the *actual* size turns out small).  Use only on
    dimension-like inputs; aggregates are left to AQE.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
