"""Deterministic replay of a table into a file-source stream, one event-time slice per trigger.

The table is cut into ``n`` equal event-time slices. For each slice (in the given order) the slice's rows
are appended to a staging folder by a distributed write, then the streaming query is run with an
``availableNow`` trigger from its checkpoint until it has consumed everything present. Each run therefore
processes exactly one slice, restarts from the checkpoint of the previous run (state, offsets and
watermark survive), and an out-of-order slice list produces genuinely late data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwise.sources.fs import make_folder
from tickwise.streaming.queries import drain


def _micros(col: str):
    c = F.col(col)
    return F.unix_micros(c.cast("timestamp"))


def slice_bounds(df: DataFrame, time_col: str, n: int) -> tuple[list[tuple[int, int]], int]:
    """``n`` half-open event-time ranges in epoch microseconds covering every row, and the row count
    (one small aggregation job)."""
    row = df.agg(F.min(_micros(time_col)).alias("lo"), F.max(_micros(time_col)).alias("hi"),
                 F.count(F.lit(1)).alias("n")).first()
    if row["lo"] is None:
        return [], 0
    lo, span = int(row["lo"]), int(row["hi"]) - int(row["lo"]) + 1
    edges = [lo + (span * k) // n for k in range(n + 1)]
    return list(zip(edges[:-1], edges[1:])), int(row["n"])


@dataclass
class SliceReplay:
    source: DataFrame
    time_col: str
    stage_path: str
    columns: Sequence[str]
    fmt: str = "text"
    n_slices: int = 5

    def __post_init__(self) -> None:
        # A file-stream source is defined over an existing folder.
        make_folder(self.source.sparkSession, self.stage_path)

    def bounds(self) -> list[tuple[int, int]]:
        if not hasattr(self, "_bounds"):
            self._bounds, self._rows = slice_bounds(self.source, self.time_col, self.n_slices)
        return self._bounds

    def rows_per_slice(self) -> int:
        self.bounds()
        return -(-self._rows // max(self.n_slices, 1))

    def _edge(self, micros: int):
        """A slice edge as a literal of the time column's own type, so the filter reaches the scan."""
        kind = dict(self.source.dtypes)[self.time_col]
        return F.timestamp_micros(F.lit(micros)).cast(kind)

    def stage(self, k: int) -> None:
        lo, hi = self.bounds()[k]
        t = F.col(self.time_col)
        part = self.source.filter((t >= self._edge(lo)) & (t < self._edge(hi))).select(*self.columns)
        part.write.mode("append").format(self.fmt).save(self.stage_path)

    def run_live(self, start_query: Callable[[dict | None], StreamingQuery],
                 order: Sequence[int] | None = None) -> None:
        """Stage the slices in time order into one running query, then restart it once to drain.

        Slices in time order can never be late (every row of a later slice is newer than any earlier
        row), so where the micro-batch boundaries fall does not change any result; one running query saves
        a start and a state reload per slice. The closing ``availableNow`` run executes the batch that
        applies the final watermark (evicting and, in append mode, emitting the closed windows).
        ``start_query(trigger)`` must start the query from its checkpoint with the given trigger.

        ``order`` other than time order is only meaningful for a stateless query (no watermark, no state),
        whose output cannot depend on batch boundaries; stateful queries fed out of order use :meth:`run`.
        """
        query = start_query(None)
        try:
            for k in (order if order is not None else range(len(self.bounds()))):
                self.stage(k)
                query.processAllAvailable()
        finally:
            query.stop()
        drain(start_query({"availableNow": True}))

    def run(self, start_query: Callable[[], StreamingQuery],
            order: Sequence[int] | None = None) -> list[dict]:
        """Stage slices one at a time in ``order`` and drain the query after each; returns progresses."""
        progress = []
        for k in (order if order is not None else range(len(self.bounds()))):
            self.stage(k)
            progress.append(drain(start_query()))
        return progress
