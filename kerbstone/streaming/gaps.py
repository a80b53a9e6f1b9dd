"""Gap groups over a stream: the session window is the streaming form of grouping by distance to the previous row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gap_sessions(events: DataFrame, keys: list[str], at: str, gap: str = "16 hours", late: str = "1 day") -> DataFrame:
    """(keys, first, last, n) of runs of events each less than ``gap`` after the one before; state goes once ``late`` has passed."""
    found = events.withWatermark(at, late).groupBy(*keys, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n"), F.min(at).alias("first"), F.max(at).alias("last"))
    return found.select(*keys, "first", "last", "n")
