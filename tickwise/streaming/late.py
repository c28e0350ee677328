"""A ledger of the ticks that a windowed query dropped as late.

Spark drops a row whose window ended at or before the watermark that the *previous* batch ran with (eviction and
append output use the current one). Both facts are in the query's checkpoint: the offset log tells each batch's
watermark and how far it read the source, the file source's log which files those were. The ledger reads them after
the query ran, reads the files of each batch again with the same parser, and keeps exactly the rows that fail that
test, one ``batch_id`` folder per batch, so collecting twice changes nothing.

With the query's progress at hand only batches that report dropped rows are read again. The progress counts what
the state operator dropped, which are groups combined per task where several late ticks share one; the ledger has
every tick.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.sources.fs import list_names, path_exists, read_text
from tickwise.streaming.flat_log import PLAIN_FILES


@dataclass(frozen=True)
class BatchLog:
    """What the checkpoint tells of one finished batch."""

    batch_id: int
    watermark_ms: int
    end: str  # the source's end offset, as the source wrote it


def finished_batches(spark: SparkSession, checkpoint: str, source: int = 0) -> list[BatchLog]:
    """The batches whose commit is logged, in order; Spark keeps the last hundred or more."""
    root = checkpoint.rstrip("/")
    done = {n for n in list_names(spark, f"{root}/commits") if n.isdigit()}
    found = []
    for name in sorted((n for n in list_names(spark, f"{root}/offsets") if n in done), key=int):
        lines = read_text(spark, f"{root}/offsets/{name}").splitlines()  # version, metadata, one line per source
        found.append(BatchLog(int(name), json.loads(lines[1])["batchWatermarkMs"], lines[2 + source]))
    return found


def files_of_batches(spark: SparkSession, checkpoint: str, batches: list[BatchLog], source: int = 0) -> dict[int, list[str]]:
    """The files that each batch read, from the file source's own log."""
    root, by_log = f"{checkpoint.rstrip('/')}/sources/{source}", {}
    for name in list_names(spark, root):
        if name.split(".")[0].isdigit():
            for line in read_text(spark, f"{root}/{name}").splitlines()[1:]:
                entry = json.loads(line)
                by_log.setdefault(entry["batchId"], set()).add(entry["path"])
    found, last = {}, -1
    for b in batches:
        end = json.loads(b.end)["logOffset"]
        found[b.batch_id] = sorted(p for k in range(last + 1, end + 1) for p in by_log.get(k, ()))
        last = end
    return found


def dropped_as_late(ticks: DataFrame, watermark_ms: int, width: str, timestamp: str = "timestamp") -> DataFrame:
    """The ticks whose window ended at or before the watermark."""
    end = F.window(F.col(timestamp), width)["end"]
    return ticks.where(F.unix_micros(end) <= F.lit(watermark_ms * 1000))


class LateLedger:
    """Late ticks of the windowed query with this checkpoint, kept below ``path``.

    ``parse`` turns a frame of text lines (column ``value``) into the query's input rows.
    """

    def __init__(self, checkpoint: str, path: str, parse: Callable[[DataFrame], DataFrame], width: str = "2 seconds",
                 timestamp: str = "timestamp"):
        self.checkpoint, self.path, self.parse = checkpoint, path.rstrip("/"), parse
        self.width, self.timestamp = width, timestamp

    def collect(self, spark: SparkSession, progress: Iterable[dict] | None = None) -> list[int]:
        """Take up the finished batches that are not in the ledger; returns those with late rows to look for."""
        batches = finished_batches(spark, self.checkpoint)
        files = files_of_batches(spark, self.checkpoint, batches)
        reported = None if progress is None else {
            p["batchId"]: sum(o.get("numRowsDroppedByWatermark", 0) for o in p.get("stateOperators") or ()) for p in progress}
        read = []
        for before, b in zip(batches, batches[1:]):
            folder = f"{self.path}/batch_id={b.batch_id}"
            if before.watermark_ms <= 0 or not files[b.batch_id] or path_exists(spark, folder):
                continue
            if reported is not None and reported.get(b.batch_id) == 0:
                continue
            late = dropped_as_late(self.parse(spark.read.text(files[b.batch_id])), before.watermark_ms, self.width,
                                   self.timestamp)
            late.write.mode("overwrite").options(**PLAIN_FILES).parquet(folder)
            read.append(b.batch_id)
        return read

    def read(self, spark: SparkSession, schema) -> DataFrame:
        """All late rows, with the batch that dropped them as ``batch_id``."""
        if not [n for n in list_names(spark, self.path) if n.startswith("batch_id=")]:
            return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(None).cast("int"))
        return spark.read.schema(schema).parquet(self.path)
