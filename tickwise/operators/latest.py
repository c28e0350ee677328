"""Latest values by event time: newest row per key and last price per time bucket.

Event time and tie-breaker are packed into one ``decimal(38,0)``, a fixed-width value, so the newest row is a
plain hash aggregation that combines partially on the map side: no sort of the input, and a key with a third of
all ticks costs one row per task. Columns of variable width (names) do not fit a hash buffer; rows that need
them are fetched by a second scan joined to the few winners.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.timefns import bucket_start
from tickwise.operators.joins import lookup_join, row_hash

_FIXED = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def fixed_width(df: DataFrame, column: str) -> bool:
    kind = dict(df.dtypes)[column]
    return kind in _FIXED or kind.startswith("decimal")


def recency(df: DataFrame, order: Sequence[str]) -> Column:
    """One number that orders rows by event time, then the tie-breaker: an integral column, or else a hash
    of the tie-breakers and the row (any tie is then broken the same way in every run)."""
    if not order:
        raise ValueError("an ordering column (event time) is required")
    kinds = dict(df.dtypes)
    time, *ties = order
    if kinds[time] in ("timestamp", "timestamp_ntz"):
        first = F.unix_micros(F.col(time).cast("timestamp"))
    elif kinds[time] in _INTEGRAL:
        first = F.col(time).cast("bigint")
    else:
        raise ValueError(f"rows cannot be ordered by {time}, a {kinds[time]}")
    if len(ties) == 1 and kinds[ties[0]] in _INTEGRAL:
        tie = F.coalesce(F.col(ties[0]).cast("bigint"), F.lit(-(1 << 63)))
    else:
        tie = F.xxhash64(*[F.col(c) for c in ties], row_hash(df))
    # Twenty digits hold any unsigned long: the tie-breaker never reaches the event time's digits.
    shifted = (tie.cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("decimal(21,0)")
    return (first.cast("decimal(18,0)") * F.lit("100000000000000000000").cast("decimal(21,0)") + shifted).cast(
        "decimal(38,0)")


def latest_per_key(ticks: DataFrame, key: str = "symbol",
                   order: Sequence[str] = ("timestamp",),
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The newest row per ``key`` by ``order`` (event time first, then tie-breakers).

    Returns ``key`` plus ``columns`` (default: every other input column) of that row, exactly one per key: rows
    that ``order`` cannot tell apart are told apart by a hash of their content. Rows with a null key form one
    group; rows without an event time are not considered.
    """
    cols = [c for c in (columns if columns is not None else ticks.columns) if c != key]
    ranked = ticks.withColumn("_rank", recency(ticks, order))
    if all(fixed_width(ticks, c) for c in cols):
        return ranked.where(F.col("_rank").isNotNull()).groupBy(key).agg(
            *[F.max_by(F.col(c), F.col("_rank")).alias(c) for c in cols])
    # Null keys are a group of their own: told apart from every real key by a flag.
    named = lambda c: [F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_key"), F.col(c).isNull().alias("_none")]
    best = ranked.groupBy(key).agg(F.max("_rank").alias("_best")).select(*named(key), "_best")
    # One row per key; whether it is broadcast follows from its checked size.
    found = lookup_join(ranked.select("*", *named(key), row_hash(ticks).alias("_hash")), best, ["_key", "_none"], "inner")
    # Rows of equal time and tie-breaker: the one of the largest hash counts, so that every key has one row. Spark
    # keeps one row per task and key before the shuffle (a window group limit).
    tied = Window.partitionBy("_key", "_none").orderBy(F.desc("_hash"))
    return (found.where(F.col("_rank") == F.col("_best")).withColumn("_place", F.row_number().over(tied))
            .where("_place = 1").select(key, *cols))


def last_in_bucket(ticks: DataFrame, width: str = "40 seconds", key: str = "symbol",
                   value: str = "price", timestamp: str = "timestamp",
                   tie_breakers: Sequence[str] = (), bucket_col: str = "time_bucket") -> DataFrame:
    """Last ``value`` (of fixed width) per (key, epoch-aligned bucket of ``width``) by event time."""
    narrow = ticks.select(key, timestamp, value, *tie_breakers)
    return (narrow.withColumn("_rank", recency(narrow, [timestamp, *tie_breakers]))
            .groupBy(F.col(key), bucket_start(timestamp, width).alias(bucket_col))
            .agg(F.max_by(F.col(value), F.col("_rank")).alias(value)))
