"""Streaming query builders: raw storage of enriched ticks and windowed statistics.

Both take the enriched tick stream (parse -> enrich) and return a started ``StreamingQuery``. Every query
has a name and its own checkpoint folder; triggers default to "as fast as possible".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickwise.operators.windows import DEFAULT_KEYS, window_stats
from tickwise.sources.fs import make_folder
from tickwise.streaming.dimension import VersionedDimension
from tickwise.streaming.flat_log import FlatLog
from tickwise.streaming.sinks import BatchWriter, append_writer


def _apply_trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


def raw_storage_query(enriched: DataFrame, output_path: str, checkpoint: str,
                      name: str = "tick_storage", exactly_once: bool = True,
                      trigger: dict | None = None, partition_by_day: bool = False,
                      timestamp: str = "timestamp", log: FlatLog | None = None,
                      dimension: VersionedDimension | None = None) -> StreamingQuery:
    """Append every enriched tick to a Parquet folder.

    No watermark: late ticks are always stored even where the windowed statistics drop them.
    ``exactly_once`` uses Spark's file sink (its ``_spark_metadata`` log makes replays idempotent; read the
    folder with Spark to honour it). Otherwise the folder stays flat, without a metadata folder: with ``log``
    every micro-batch is stored once (:class:`~tickwise.streaming.flat_log.FlatLog`; keep it beside the checkpoint),
    without one micro-batches are appended at least once (:func:`~tickwise.streaming.sinks.append_writer`).
    ``dimension`` joins every micro-batch of bare ticks to the dimension version it resolves to (flat folder only).
    ``partition_by_day`` writes ``day=YYYY-MM-DD`` sub-folders (UTC event date) so that time-bounded reads
    skip whole days; the flat layout of the original job is the default.
    """
    rows = enriched.withColumn("day", F.to_date(F.col(timestamp))) if partition_by_day else enriched
    parts = ("day",) if partition_by_day else ()
    w = rows.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
    if exactly_once:
        w = w.format("parquet").option("path", output_path)
        if parts:
            w = w.partitionBy(*parts)
        if dimension is not None:
            raise ValueError("a versioned dimension is joined per micro-batch, which Spark's file sink cannot do")
    else:
        store = log.writer(partition_by=parts) if log else append_writer(output_path, partition_by=parts)
        w = w.foreachBatch(dimension.joined(store) if dimension else store)
    return _apply_trigger(w, trigger).start()


def stored_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What a storage query stores, as a stream: a query chained to it reads its source no second time.

    Both stored layouts hand out each row once: files of the flat layout are final when they appear, and Spark's
    file sink is followed through its metadata log. Spark lists a flat folder for every trigger; for a table of very
    many files store through the file sink, whose log is read instead.
    """
    make_folder(spark, path)
    return spark.readStream.schema(schema).parquet(path)


def window_stats_stream(enriched: DataFrame, width: str = "2 seconds", delay: str = "2 seconds",
                        keys: Sequence[str] = DEFAULT_KEYS, timestamp: str = "timestamp",
                        price: str = "price") -> DataFrame:
    """Watermarked tumbling-window statistics of a stream (event time must be TIMESTAMP)."""
    return window_stats(enriched, width, keys, timestamp, price, watermark=delay)


def window_stats_query(enriched: DataFrame, checkpoint: str, sink: str | BatchWriter = "console",
                       width: str = "2 seconds", delay: str = "2 seconds",
                       keys: Sequence[str] = DEFAULT_KEYS, output_mode: str = "update",
                       name: str = "tick_window_stats", trigger: dict | None = None,
                       sink_options: dict | None = None) -> StreamingQuery:
    """Start the windowed statistics query.

    ``update`` emits, per trigger, only the groups that changed; ``append`` emits each window once, after
    the watermark has passed its end. ``sink`` is a format name (``console``, ``memory``, ...) or a
    ``foreachBatch`` function such as :func:`~tickwise.streaming.sinks.versioned_writer`.
    State is spread over the session's ``spark.sql.shuffle.partitions``, kept in the checkpoint from the first
    start on: set it for the stream's full load, not for its first batch.
    """
    stats = window_stats_stream(enriched, width, delay, keys)
    w = (stats.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint))
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink)
        if sink == "console":
            w = w.option("truncate", "false").option("numRows", "20")
    if sink_options:
        w = w.options(**sink_options)
    return _apply_trigger(w, trigger).start()


def kafka_sink_query(records: DataFrame, options: dict[str, str], checkpoint: str,
                     name: str = "tick_publisher", trigger: dict | None = None) -> StreamingQuery:
    """Publish a stream of ``key, value`` records (see ``functions.encode.kafka_records``) to Kafka;
    ``options`` from ``sources.kafka.sink_options``. Needs the Kafka connector on the classpath."""
    w = (records.select("key", "value").writeStream.queryName(name).format("kafka").options(**options)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _apply_trigger(w, trigger).start()


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Block until any active query terminates (re-raises its failure)."""
    return spark.streams.awaitAnyTermination(timeout)


def drain(query: StreamingQuery) -> dict:
    """Wait for a bounded (``availableNow``) query to finish and return its last progress."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"streaming query {query.name} failed: {query.exception()}")
    return query.lastProgress or {}
