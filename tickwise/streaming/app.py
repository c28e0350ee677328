"""The streaming application: raw storage and windowed statistics from one tick feed.

Registers the external table over the storage folder, then starts two independent, named queries over the
same lineage (messages -> strict parse -> left enrichment with the metadata file):

* ``tick_storage``: every enriched tick appended to the table folder (no watermark, late ticks kept);
* ``tick_window_stats``: watermarked tumbling-window statistics in update mode (console by default).

Each query reads the source itself (own offsets) and has its own checkpoint folder; with ``live_metadata`` the
second one reads what the first one stored. The source is Kafka in
production; a folder of JSON-lines files serves the same plan for replays and tests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickwise.config import Settings, use_utc
from tickwise.functions.parse import parse_ticks
from tickwise.operators.enrich import enrich
from tickwise.plans import catalog
from tickwise.schemas import ENRICHED, ENRICHED_FIELDS
from tickwise.sources import kafka
from tickwise.sources.files import pin_metadata, replay_stream
from tickwise.streaming import queries as sq
from tickwise.streaming.dimension import VersionedDimension
from tickwise.streaming.flat_log import FlatLog
from tickwise.streaming.sinks import BatchWriter


@dataclass
class RunningApp:
    storage: StreamingQuery
    analytics: StreamingQuery

    def queries(self) -> list[StreamingQuery]:
        return [self.storage, self.analytics]

    def stop(self) -> None:
        for q in self.queries():
            q.stop()


def parsed_ticks(spark: SparkSession, settings: Settings, source: str = "kafka", path: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages -> parsed ticks."""
    if source == "kafka":
        messages = kafka.read_stream(spark, settings)
    elif source == "files":
        messages = replay_stream(spark, path, "text",
                                 max_files_per_trigger=max_files_per_trigger).withColumnRenamed("value", "json")
    else:
        raise ValueError(f"unknown source {source!r}")
    return parse_ticks(messages)


def enriched_ticks(spark: SparkSession, settings: Settings, source: str = "kafka",
                   path: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """The shared lineage: messages -> parsed ticks -> enriched ticks (stored-table column order)."""
    ticks = parsed_ticks(spark, settings, source, path, max_files_per_trigger)
    metadata, small = pin_metadata(spark, settings.metadata_path, f"{settings.checkpoint_path}/metadata",
                                   settings.broadcast_max_rows, settings.broadcast_max_bytes)
    return enrich(ticks, metadata, key="symbol", broadcast=small).select(*ENRICHED_FIELDS)


def storage_log(settings: Settings) -> FlatLog:
    """The commit log of the stored table, part of the storage query's checkpoint."""
    return FlatLog(settings.output_path, f"{settings.checkpoint_path}/crypto_info/files")


def start(spark: SparkSession, settings: Settings, source: str = "kafka", path: str | None = None,
          analytics_sink: str | BatchWriter = "console", exactly_once: bool = False,
          trigger: dict | None = None, max_files_per_trigger: int | None = None,
          live_metadata: bool = False) -> RunningApp:
    """Register the table and start both queries.

    ``exactly_once=False`` keeps the original flat folder of Parquet files, each micro-batch stored once through
    its commit log; ``True`` uses Spark's file sink with its metadata log.

    ``live_metadata`` lets edits of the metadata file take effect while the application runs: every micro-batch is
    joined to the checked version of its time, and the statistics follow the stored table as a stream, so that
    both outputs saw the same version and the source is read once. Otherwise the file is pinned at the start.
    """
    use_utc(spark)
    catalog.register_table(spark, settings.database, settings.table, settings.output_path, replace=True,
                           partition_by_day=settings.partition_by_day)
    log = None if exactly_once else storage_log(settings)
    stats_checkpoint = f"{settings.checkpoint_path}/window_stats"
    if live_metadata:
        stream, dimension = parsed_ticks(spark, settings, source, path, max_files_per_trigger), VersionedDimension(
            settings.metadata_path, f"{settings.checkpoint_path}/metadata", max_rows=settings.broadcast_max_rows,
            max_bytes=settings.broadcast_max_bytes)
    else:
        stream, dimension = enriched_ticks(spark, settings, source, path, max_files_per_trigger), None
    storage = sq.raw_storage_query(stream, settings.output_path, f"{settings.checkpoint_path}/crypto_info",
                                   name="tick_storage", exactly_once=exactly_once, trigger=trigger,
                                   partition_by_day=settings.partition_by_day, log=log, dimension=dimension)
    if live_metadata:
        stream = sq.stored_stream(spark, settings.output_path, ENRICHED)
    analytics = sq.window_stats_query(stream, stats_checkpoint, analytics_sink,
                                      settings.window_width, settings.watermark_delay,
                                      name="tick_window_stats", trigger=trigger)
    return RunningApp(storage, analytics)


def run_forever(spark: SparkSession, settings: Settings, **kw) -> None:
    """Start both queries and block until either stops (its failure is re-raised)."""
    app = start(spark, settings, **kw)
    for q in app.queries():
        print(f"Started streaming query: {q.name}")
    sq.await_any(spark)
