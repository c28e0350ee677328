"""Event-time helpers: epoch-aligned buckets, shifts, dense bucket series and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def bucket_start(ts: Column | str, width: str) -> Column:
    """Floor a timestamp to an epoch-aligned bucket of ``width`` (e.g. ``"40 seconds"``).

    Uses the tumbling-window expression, which Spark evaluates as plain arithmetic (no row expansion),
    and keeps the input's timestamp type.
    """
    return F.window(_col(ts), width).start


def shift(ts: Column | str, secs: int) -> Column:
    """``ts`` moved by a whole number of seconds (negative = earlier)."""
    return _col(ts) + seconds(secs)


def bucket_series(start: Column | str, stop: Column | str, step_seconds: int) -> Column:
    """Array of bucket starts from ``start`` to ``stop``, both ends inclusive."""
    return F.sequence(_col(start), _col(stop), seconds(step_seconds))


def time_label(ts: Column | str) -> Column:
    """Clock label ``HH:mm:ss``."""
    return F.date_format(_col(ts), "HH:mm:ss")
