"""Table summaries: counts, event-time range, rows per key, distinct keys, newest rows, key slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, alias: str = "record_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def time_range(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    return df.agg(F.min(timestamp).alias("first_event_timestamp"),
                  F.max(timestamp).alias("latest_event_timestamp"))


def rows_by_key(df: DataFrame, keys: Sequence[str] = ("symbol", "coin_name", "category"),
                sort: bool = True) -> DataFrame:
    """Row count per key combination, largest first, then by the first key."""
    keys = list(keys)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), *keys) if sort else out


def distinct_values(df: DataFrame, column: str = "symbol") -> DataFrame:
    """Sorted distinct non-null values of one column."""
    return df.select(column).na.drop().distinct().orderBy(column)


def newest(df: DataFrame, n: int = 20, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """The ``n`` newest rows by ``order`` (event time then tie-breakers), newest first.

    A top-k: each task keeps its own ``n`` best rows and only those are merged.
    """
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows (``SELECT * ... LIMIT n``); which rows is undefined."""
    return df.limit(n)


def key_slice(df: DataFrame, value, column: str = "symbol") -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def key_profile(df: DataFrame, keys: Sequence[str] = ("symbol", "coin_name", "category"),
                timestamp: str = "timestamp") -> DataFrame:
    """Rows and event-time range per key combination, in one scan.

    Global row count and range follow from this small result, so a report needs a single pass.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"),
                                 F.min(timestamp).alias("first_event_timestamp"),
                                 F.max(timestamp).alias("latest_event_timestamp"))
