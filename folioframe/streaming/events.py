"""Incremental operators: windowed counts with late data, first-seen items, and alerts past a stored watermark.

Each takes a streaming or a batch DataFrame and gives the same rows once all input is in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(events: DataFrame, ts: str, keys: list[str], size: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts by key and window; rows later than `late` are not counted in a stream."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return events.withWatermark(ts, late).groupBy(*keys, w.alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(items: DataFrame, key: str, ts: str, keep: str = "30 days") -> DataFrame:
    """Items whose key was not seen before, with state kept for a bounded time."""
    return items.withWatermark(ts, keep).dropDuplicatesWithinWatermark([key])


def alerts(items: DataFrame, subscriptions: DataFrame, key: str, ts: str, seen: str) -> DataFrame:
    """Items newer than what each subscription has seen: (subscription columns, item columns)."""
    return items.join(subscriptions, key).where(F.col(ts) > F.col(seen))


def advanced(subscriptions: DataFrame, sent: DataFrame, key: str, ts: str, seen: str) -> DataFrame:
    """Subscriptions with their watermark moved to the newest item sent."""
    newest = sent.groupBy(key).agg(F.max(ts).alias("__newest"))
    return subscriptions.join(newest, key, "left").withColumn(seen, F.greatest(F.col(seen), F.col("__newest"))).drop("__newest")
