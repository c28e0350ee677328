"""Dense per-key time grid for trend charts.

For every key: the newest bucket ``B`` (bucket of the newest tick), then every bucket start from
``floor(B - history)`` to ``B + lookahead`` inclusive, each with the last price of that bucket or null.

Only the ticks inside each key's chart frame are aggregated: a first pass finds each key's newest event
time (a partial aggregation, one tiny row per key), written once and reused by both branches below. The frames
of all keys are merged to a few disjoint time ranges that are pushed into the second scan, so a key that fell
silent long ago adds its own minutes to that scan and not everything since. The frame table is then joined to
the ticks and filtered per key. Batch only: a stream has no newest bucket yet, and is refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.config import written
from tickwise.functions.timefns import bucket_series, bucket_start, shift, time_label
from tickwise.operators.joins import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, lookup_join, row_bytes
from tickwise.operators.latest import last_in_bucket

#: Time ranges pushed into the second scan; frames are joined over the smallest gaps down to this many.
MOST_RANGES = 32
#: Frame pieces from which those ranges are merged (one per distinct hour and not per key).
_PIECE_SECONDS = 3600


def chart_frames(ticks: DataFrame, key: str = "symbol", timestamp: str = "timestamp",
                 bucket_seconds: int = 40, history_minutes: int = 10,
                 lookahead_seconds: int = 60) -> DataFrame:
    """One row per key: ``latest_bucket, grid_start, grid_end``."""
    width = f"{bucket_seconds} seconds"
    newest = ticks.groupBy(key).agg(F.max(timestamp).alias("_newest"))
    latest = bucket_start("_newest", width)
    return newest.select(
        key,
        latest.alias("latest_bucket"),
        bucket_start(shift(latest, -60 * history_minutes), width).alias("grid_start"),
        shift(latest, lookahead_seconds).alias("grid_end"),
    )


def frame_ranges(frames: DataFrame, most: int = MOST_RANGES, piece: int = _PIECE_SECONDS) -> list[tuple[int, int]]:
    """At most ``most`` disjoint ranges, in epoch microseconds, that cover every frame.

    Frames are first gathered per time piece they start in; where even those are many, the driver gets no more
    than 10,000 of the widest pieces' bounds by using coarser pieces.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    own = frames.where(F.col("grid_start").isNotNull()).select(micros("grid_start").alias("s"), micros("grid_end").alias("e"))
    while True:
        pieces = own.groupBy(F.floor(F.col("s") / F.lit(piece * 1_000_000)).alias("p")).agg(
            F.min("s").alias("s"), F.max("e").alias("e"))
        if pieces.count() <= 10_000:
            break
        piece *= 16
    ranges = []
    for r in sorted((r["s"], r["e"]) for r in pieces.collect()):
        if ranges and r[0] <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], r[1]))
        else:
            ranges.append(r)
    if len(ranges) > most:
        gaps = sorted(range(1, len(ranges)), key=lambda k: ranges[k][0] - ranges[k - 1][1], reverse=True)
        cuts = [0, *sorted(gaps[:most - 1]), len(ranges)]
        ranges = [(ranges[a][0], ranges[b - 1][1]) for a, b in zip(cuts, cuts[1:])]
    return ranges


def dense_trend_grid(ticks: DataFrame, key: str = "symbol", timestamp: str = "timestamp",
                     price: str = "price", tie_breakers: Sequence[str] = (),
                     bucket_seconds: int = 40, history_minutes: int = 10,
                     lookahead_seconds: int = 60, only_priced: bool = False,
                     broadcast: bool | None = None) -> DataFrame:
    """``key, time_bucket, price, time_label`` for every grid point of every key.

    ``only_priced`` keeps just the grid points that have a price (the points a chart draws).
    """
    if ticks.isStreaming:
        raise ValueError("the trend grid is a batch result: store the stream and build the grid over the table")
    width = f"{bucket_seconds} seconds"
    frames = written(chart_frames(ticks, key, timestamp, bucket_seconds, history_minutes, lookahead_seconds),
                     "chart_frames")
    recent = ticks.select(key, timestamp, price, *tie_breakers)
    lookup = frames.select(key, "grid_start")
    ranges = frame_ranges(frames)
    if ranges:
        kind = dict(ticks.dtypes)[timestamp]
        edge = lambda m: F.timestamp_micros(F.lit(m)).cast(kind)
        recent = recent.filter(reduce(lambda a, b: a | b, [
            (F.col(timestamp) >= edge(s)) & (F.col(timestamp) <= edge(e)) for s, e in ranges]))
    if broadcast is None:
        stats = lookup.agg(F.count(F.lit(1)).alias("rows"),
                           F.coalesce(F.sum(row_bytes(lookup)), F.lit(0)).alias("bytes")).first()
        broadcast = stats["rows"] <= DEFAULT_MAX_ROWS and stats["bytes"] <= DEFAULT_MAX_BYTES
    in_frame = (lookup_join(recent, lookup, key, "inner", broadcast=broadcast)
                .filter(F.col(timestamp) >= F.col("grid_start")))
    points = last_in_bucket(in_frame, width, key, price, timestamp, tie_breakers)
    grid = frames.select(key, F.explode(bucket_series("grid_start", "grid_end", bucket_seconds))
                         .alias("time_bucket"))
    out = grid.join(points, [key, "time_bucket"], "left")
    if only_priced:
        out = out.filter(F.col(price).isNotNull())
    return out.select(key, "time_bucket", price, time_label("time_bucket").alias("time_label"))
