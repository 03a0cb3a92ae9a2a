"""Unbounded forms: deduplication within a watermark, windows and sessions over events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(events: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """First arrival of each key; state is dropped behind the watermark."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def windowed(events: DataFrame, ts: str = "ts", size: str = "1 hour", slide: str | None = None, delay: str | None = "1 day") -> DataFrame:
    """Counts and sums per window and kind; late rows count up to the watermark.

    ``delay`` None keeps the watermark that the stream has already.
    """
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    events = events.withWatermark(ts, delay) if delay else events
    out = events.groupBy(w.alias("w"), "type").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "type", "n", "amount")


def sessions(events: DataFrame, ts: str = "ts", gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Activity sessions of a player, closed by a gap."""
    out = events.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), "player").agg(F.count("*").alias("n"))
    return out.select("player", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
