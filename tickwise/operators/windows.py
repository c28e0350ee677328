"""Tumbling-window price statistics (average, maximum, minimum, count).

One operator for streaming and batch input. Spark evaluates a tumbling window as arithmetic on the event
time and aggregates partially before the shuffle, so a group holding a large share of all ticks is
reduced to one row per map task before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_KEYS = ("symbol", "coin_name", "category")


def window_stats(ticks: DataFrame, width: str = "2 seconds", keys: Sequence[str] = DEFAULT_KEYS,
                 timestamp: str = "timestamp", price: str = "price",
                 watermark: str | None = None, drop_unmatched: bool = False,
                 round_average: int | None = None) -> DataFrame:
    """Per (window, keys): ``average_price, max_price, min_price, event_count``.

    Windows are epoch-aligned and half-open ``[window_start, window_end)``. Null key values form their own
    group (streaming semantics) unless ``drop_unmatched`` is set, which reproduces a grouping that skips
    rows with a missing key. ``watermark`` (e.g. ``"2 seconds"``) bounds the state of a streaming query;
    the timestamp must then be of type TIMESTAMP. ``event_count`` counts non-null prices.
    """
    keys = list(keys)
    src = ticks.withWatermark(timestamp, watermark) if watermark else ticks
    if drop_unmatched:
        src = src.na.drop(subset=keys)
    avg = F.avg(price)
    if round_average is not None:
        avg = F.round(avg, round_average)
    grouped = src.groupBy(F.window(F.col(timestamp), width).alias("window"), *keys).agg(
        avg.alias("average_price"),
        F.max(price).alias("max_price"),
        F.min(price).alias("min_price"),
        F.count(price).alias("event_count"),
    )
    return grouped.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), *keys,
                          "average_price", "max_price", "min_price", "event_count")


def bucket_stats(ticks: DataFrame, width: str = "2 seconds", keys: Sequence[str] = DEFAULT_KEYS,
                 timestamp: str = "timestamp", price: str = "price", drop_unmatched: bool = True,
                 round_average: int | None = None) -> DataFrame:
    """Dashboard form of :func:`window_stats`: the bucket start as ``time_bucket``, no window end.

    Defaults to skipping rows with a missing key, like a table grouping that ignores null keys.
    """
    stats = window_stats(ticks, width, keys, timestamp, price, drop_unmatched=drop_unmatched,
                         round_average=round_average)
    return stats.select(F.col("window_start").alias("time_bucket"), *keys,
                        "average_price", "max_price", "min_price", "event_count")
