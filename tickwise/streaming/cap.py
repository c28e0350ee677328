"""A total cap on the events a stream publishes.

The total after each micro-batch is recorded under its batch id, once the batch is written. The next batch may
write what the cap leaves: all of it, its first rows by ``order``, or nothing. A restarted or replayed batch starts
from the total of the batch before it, so exactly ``limit`` events are let through over any number of triggers and
restarts, as far as the writer stores a replayed batch once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tickwise.plans.ingest import cap_events
from tickwise.sources.fs import delete_path, list_names, publish_text, read_text

_WIDTH = 20


class EventCap:
    """At most ``limit`` events (0: unlimited), with the running total below ``folder``, beside the checkpoint."""

    def __init__(self, limit: int, folder: str, order: Sequence[str] = ("timestamp", "symbol")):
        self.limit, self.folder, self.order = limit, folder.rstrip("/"), tuple(order)

    def total(self, spark: SparkSession, before: int | None = None) -> int:
        """Events let through so far, or by the batches before one."""
        names = [n for n in list_names(spark, self.folder)
                 if n.endswith(".json") and (before is None or n < f"{before:0{_WIDTH}d}")]
        return json.loads(read_text(spark, f"{self.folder}/{max(names)}"))["total"] if names else 0

    def reached(self, spark: SparkSession) -> bool:
        return 0 < self.limit <= self.total(spark)

    def capped(self, write: Callable[[DataFrame, int], object]) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that hands on what the cap leaves of each batch."""
        def run(batch: DataFrame, batch_id: int) -> None:
            if self.limit <= 0:
                write(batch, batch_id)
                return
            spark = batch.sparkSession
            before = self.total(spark, before=batch_id)
            left = self.limit - before
            taken = 0
            if left > 0:
                held = batch.persist(StorageLevel.MEMORY_AND_DISK)
                try:
                    taken = min(left, held.count())
                    if taken:
                        write(cap_events(held, left, self.order), batch_id)
                finally:
                    held.unpersist()
            publish_text(spark, f"{self.folder}/{batch_id:0{_WIDTH}d}.json", json.dumps({"total": before + taken}))
            for name in list_names(spark, self.folder):  # the record before is kept for a replay
                if name.endswith(".json") and name < f"{batch_id - 1:0{_WIDTH}d}":
                    delete_path(spark, f"{self.folder}/{name}")

        return run

    def await_end(self, query: StreamingQuery, poll_seconds: float = 1.0) -> None:
        """Block until the query ends or the cap is reached, and stop it then."""
        spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.getActiveSession()
        while not query.awaitTermination(poll_seconds):
            if self.reached(spark):
                query.stop()
                return
