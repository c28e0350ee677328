"""Rollups: mergeable window states kept as a table, coarser widths built from them.

A state is what statistics of one bucket and key merge from: sum, count, minimum and maximum. Every micro-batch is
reduced to its states, which are merged into the stored ones; only the segments (spans of event time, an hour by
default) that it touches are rewritten, each as a new version. A record per batch names every segment's current
version and appears last and whole. A replayed batch starts from the record before it, so it replaces its own
versions and counts nothing twice; a reader keeps the version it began with until the batch after next.

Late and out-of-order ticks simply merge into their bucket. Any width that is a multiple of the stored one is read
from the states, never from the ticks.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.timefns import bucket_start
from tickwise.sources.fs import delete_path, list_names, publish_text, read_text
from tickwise.streaming.flat_log import PLAIN_FILES

_WIDTH = 12


def states(ticks: DataFrame, width: str, keys: Sequence[str], timestamp: str = "timestamp", price: str = "price") -> DataFrame:
    """bucket, keys, total, n, low, high per bucket of ``width``; ticks without an event time are left out."""
    return ticks.where(F.col(timestamp).isNotNull()).groupBy(bucket_start(timestamp, width).alias("bucket"), *keys).agg(
        F.sum(price).alias("total"), F.count(price).alias("n"), F.min(price).alias("low"), F.max(price).alias("high"))


def merged(found: DataFrame, bucket, keys: Sequence[str], *more: str) -> DataFrame:
    """States of equal bucket and keys as one."""
    return found.groupBy(bucket.alias("bucket"), *keys, *more).agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


class RollupTable:
    """The state table at ``path``: buckets of ``width``, rewritten by segments of ``segment_seconds``."""

    def __init__(self, path: str, width: str = "2 seconds", keys: Sequence[str] = ("symbol",),
                 segment_seconds: int = 3600, timestamp: str = "timestamp", price: str = "price"):
        self.path, self.width, self.keys, self.segment_seconds = path.rstrip("/"), width, list(keys), segment_seconds
        self.timestamp, self.price = timestamp, price

    def _record(self, spark: SparkSession, before: int | None = None) -> dict:
        names = [n for n in list_names(spark, f"{self.path}/records")
                 if n.endswith(".json") and (before is None or n < f"{before:0{_WIDTH}d}")]
        return json.loads(read_text(spark, f"{self.path}/records/{max(names)}")) if names else {"batch": -1, "segments": {}}

    def _folder(self, segment, version: int) -> str:
        return f"{self.path}/states/version={version:0{_WIDTH}d}/segment={segment}"

    def _load(self, spark: SparkSession, folders: Sequence[str], schema=None) -> DataFrame:
        reader = spark.read.option("basePath", f"{self.path}/states")
        return (reader.schema(schema) if schema is not None else reader).parquet(*folders)

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Merge a micro-batch; False if its record is there already."""
        spark = batch.sparkSession
        if self._record(spark)["batch"] >= batch_id:
            return False
        old = self._record(spark, before=batch_id)
        stage = f"{self.path}/staged/{batch_id:0{_WIDTH}d}"
        seconds = F.floor(F.unix_micros(F.col("bucket").cast("timestamp")) / (1_000_000 * self.segment_seconds))
        (states(batch, self.width, self.keys, self.timestamp, self.price).withColumn("segment", seconds.cast("bigint"))
         .write.mode("overwrite").options(**PLAIN_FILES).parquet(stage))
        new = spark.read.parquet(stage)
        touched = [r["segment"] for r in new.select("segment").distinct().collect()]  # spans of time, not rows
        segments = dict(old["segments"])
        if touched:
            kept = [self._folder(s, segments[str(s)]) for s in touched if str(s) in segments]
            whole = new.unionByName(self._load(spark, kept).select(*new.columns)) if kept else new
            (merged(whole, F.col("bucket"), self.keys, "segment").write.mode("overwrite").options(**PLAIN_FILES)
             .partitionBy("segment").parquet(f"{self.path}/states/version={batch_id:0{_WIDTH}d}"))
            segments |= {str(s): batch_id for s in touched}
        publish_text(spark, f"{self.path}/records/{batch_id:0{_WIDTH}d}.json",
                     json.dumps({"batch": batch_id, "segments": segments, "replaced": [
                         self._folder(s, old["segments"][str(s)]) for s in touched if str(s) in old["segments"]]}))
        delete_path(spark, stage)
        for folder in old.get("replaced", []):  # replaced by the batch before: no reader begins with these any more
            delete_path(spark, folder)
        for name in list_names(spark, f"{self.path}/records"):
            if name.endswith(".json") and name < f"{old['batch']:0{_WIDTH}d}":
                delete_path(spark, f"{self.path}/records/{name}")
        return True

    def read(self, spark: SparkSession) -> DataFrame:
        """The states: bucket, keys, total, n, low, high."""
        segments = self._record(spark)["segments"]
        if not segments:
            raise FileNotFoundError(f"{self.path} holds no states yet")
        found = self._load(spark, [self._folder(s, v) for s, v in segments.items()])
        return found.select("bucket", *self.keys, "total", "n", "low", "high")

    def rollup(self, spark: SparkSession, width: str | None = None) -> DataFrame:
        """Window statistics of a width that is a multiple of the stored one, from the states."""
        width = width or self.width
        found = merged(self.read(spark), bucket_start("bucket", width), self.keys)
        return found.select(F.col("bucket").alias("window_start"), (F.col("bucket") + F.expr(f"INTERVAL {width}")).alias(
            "window_end"), *self.keys, (F.col("total") / F.col("n")).alias("average_price"), F.col("high").alias("max_price"),
            F.col("low").alias("min_price"), F.col("n").alias("event_count"))
