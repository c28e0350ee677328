"""Registered streaming queries: the original job's two streams, replayed from the shared tables.

Each query stages ``events`` as JSON messages in five event-time slices (see ``replay``) and runs the real
Structured Streaming plan (file source -> strict parse -> stream-static enrichment -> watermarked 2-second
windows in update or append mode / raw append storage). Slices in time order, and any order for the
stateless storage queries, feed one running query that is restarted once at the end; the stateful
out-of-order replay restarts from its checkpoint for every slice. Each query returns a batch DataFrame over
what its sink wrote. Scratch folders live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.config import Settings, scratch_path, use_utc
from tickwise.functions.parse import parse_ticks
from tickwise.operators.enrich import enrich
from tickwise.plans import catalog
from tickwise.plans.registered import ORACLE_SQL as BATCH_SQL, ROUND
from tickwise.plans.registered import _ENRICHED, _stats_sql
from tickwise.sources import tables
from tickwise.sources.files import read_table, replay_stream
from tickwise.sources.fs import delete_path, files_below, list_names, move, publish_text
from tickwise.streaming import app
from tickwise.streaming import queries as sq
from tickwise.streaming.replay import SliceReplay
from tickwise.streaming.sinks import append_writer, latest_updates, versioned_writer

# Parsed message: the tick plus the two ids the shared table carries (dimension key and tie-breaker).
MESSAGE = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_id", T.LongType(), True),
])
STAT_KEYS = ("symbol", "coin_name", "category")
SLICES = 5
LATE_ORDER = (0, 1, 2, 4, 3)   # slice 3 arrives after slice 4: all of it is behind the watermark


def _enriched_stream(spark: SparkSession, sf: str, stage: str) -> DataFrame:
    raw = replay_stream(spark, stage, "text").withColumnRenamed("value", "json")
    ticks = parse_ticks(raw, schema=MESSAGE, required=("symbol", "price", "timestamp"))
    dim = tables.dimension(spark, sf)
    return enrich(ticks, dim, key="user_id")


def _replay(spark: SparkSession, sf: str, root: str) -> SliceReplay:
    return SliceReplay(tables.id_messages(spark, sf), "ts", f"{root}/stage", ["json"], "text", SLICES)


def _stats_run(spark: SparkSession, sf: str, order=None, output_mode: str = "update") -> DataFrame:
    use_utc(spark)
    root = scratch_path(spark, "stream_window_stats")
    out = f"{root}/out"
    replay = _replay(spark, sf, root)
    stream = _enriched_stream(spark, sf, replay.stage_path)

    def start(trigger):
        return sq.window_stats_query(stream, f"{root}/checkpoint", versioned_writer(out), "2 seconds",
                                     "2 seconds", STAT_KEYS, output_mode=output_mode, trigger=trigger)

    if order is None:
        # In time order: one running query; update-mode results do not depend on eviction timing.
        replay.run_live(start)
    else:
        replay.run(lambda: start({"availableNow": True}), order)   # out of order: batch per slice
    _forget(spark, root)
    if output_mode == "append":
        return _statistics(spark.read.parquet(out))  # every window must have been emitted exactly once
    return _statistics(latest_updates(spark, out, ["window_start", "window_end", *STAT_KEYS]))


def _statistics(final: DataFrame) -> DataFrame:
    return final.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                        F.col("window_end").cast("timestamp_ntz").alias("window_end"), *STAT_KEYS,
                        F.round("average_price", ROUND).alias("average_price"),
                        "max_price", "min_price", "event_count")


def _forget(spark: SparkSession, root: str) -> None:
    """Drop what only the finished run needed: its staged messages and checkpoints."""
    for part in ("stage", "checkpoint", "checkpoints", "metadata"):
        delete_path(spark, f"{root}/{part}")


def stream_window_stats(spark: SparkSession, sf: str) -> DataFrame:
    """2-second windows, 2-second watermark, update mode; last update per window and key."""
    return _stats_run(spark, sf)


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Same, with slice 3 delivered after slice 4: its rows are behind the watermark and dropped."""
    return _stats_run(spark, sf, LATE_ORDER)


def stream_window_stats_append(spark: SparkSession, sf: str) -> DataFrame:
    """Append mode: each window is emitted once, when the watermark passes its end. Windows still open
    when the replay ends (end after the newest event time minus 2 s) are never emitted."""
    return _stats_run(spark, sf, output_mode="append")


def _stored(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id", "coin_name", "category", "event_id", "symbol", "price",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def _store_run(spark: SparkSession, sf: str, exactly_once: bool) -> tuple[str, str]:
    use_utc(spark)
    root = scratch_path(spark, "stream_raw_store")
    out = f"{root}/table"
    replay = _replay(spark, sf, root)
    stream = _enriched_stream(spark, sf, replay.stage_path)
    # Stateless storage: delivery order and batch boundaries cannot change what is stored, so one live
    # query takes the slices, late ones included.
    replay.run_live(lambda trigger: sq.raw_storage_query(stream, out, f"{root}/checkpoint",
                                                         exactly_once=exactly_once, trigger=trigger),
                    order=LATE_ORDER)
    _forget(spark, root)
    return root, out


def stream_raw_store(spark: SparkSession, sf: str) -> DataFrame:
    """Raw append storage through Spark's file sink; late slices are stored in full."""
    _, out = _store_run(spark, sf, exactly_once=True)
    return _stored(spark.read.parquet(out))


def stream_flat_store(spark: SparkSession, sf: str) -> DataFrame:
    """Raw storage in the flat-folder layout (micro-batches appended as plain Parquet files), read through
    an external catalog table registered over the folder."""
    root, out = _store_run(spark, sf, exactly_once=False)
    name = catalog.register_table(spark, "tickwise_replay", "ticks_" + root.rsplit("/", 1)[-1][:12], out,
                                  columns_ddl="symbol STRING, coin_name STRING, category STRING, "
                                              "user_id BIGINT, price DOUBLE, timestamp TIMESTAMP, "
                                              "event_id BIGINT")
    return _stored(read_table(spark, name))


def stream_file_count(spark: SparkSession, sf: str) -> DataFrame:
    """Data files directly in the stored folder, after it was rewritten as one file per event day; one more file
    in a sub-folder and one of another kind do not count."""
    root, out = _store_run(spark, sf, exactly_once=False)
    stored = spark.read.parquet(out).withColumn("day", F.to_date("timestamp"))
    stored.repartition("day").write.partitionBy("day").parquet(f"{root}/days")
    for k, name in enumerate(files_below(spark, f"{root}/days")):  # a file per day
        move(spark, f"{root}/days/{name}", f"{root}/flat/day-{k:05d}.parquet")
    move(spark, f"{out}/{files_below(spark, out)[0]}", f"{root}/flat/below/other.parquet")
    publish_text(spark, f"{root}/flat/notes.txt", "not a data file")
    return catalog.count_data_files(spark, f"{root}/flat")


def stream_empty_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The flat writer given an empty micro-batch, then all ticks: files and rows after each."""
    use_utc(spark)
    root = scratch_path(spark, "stream_empty_batches")
    write = append_writer(f"{root}/table")
    ticks = tables.ticks(spark, sf)
    write(ticks.where(F.lit(False)), 0)
    files = catalog.count_data_files(spark, f"{root}/table").first()["file_count"]
    write(ticks, 1)
    return spark.read.parquet(f"{root}/table").agg(F.count(F.lit(1)).alias("stored_rows")).select(
        F.lit(files).cast("long").alias("files_after_empty"), "stored_rows")


def stream_flat_files(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of the flat stored folder that are no data file, hidden ones counted: none."""
    _, out = _store_run(spark, sf, exactly_once=False)
    names = list_names(spark, out)
    rows = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("stored_rows"))
    return rows.select(F.lit(sum(not n.endswith(".parquet") for n in names)).cast("long").alias("other_entries"),
                       "stored_rows")


def _app_run(spark: SparkSession, sf: str) -> tuple[Settings, str]:
    """The two-query application over the replayed events, slice by slice in time order, both queries
    running throughout (in-order slices cannot be late, so batch boundaries do not change results).

    Its metadata file is derived from ``events`` by Spark: one row per symbol (name = upper-case symbol,
    category from the symbol's length), written as a header CSV folder.
    """
    use_utc(spark)
    root = scratch_path(spark, "stream_app")
    symbols = tables.load(spark, sf, "events").select(F.col("event_type").alias("symbol")).distinct()
    (symbols.select("symbol", F.upper("symbol").alias("coin_name"),
                    F.concat(F.lit("kind-"), F.length("symbol").cast("string")).alias("category"))
     .write.option("header", True).csv(f"{root}/metadata"))
    replay = _replay(spark, sf, root)
    settings = Settings(metadata_path=f"{root}/metadata", output_path=f"{root}/table",
                        checkpoint_path=f"{root}/checkpoints", database="tickwise_app",
                        table="ticks_" + root.rsplit("/", 1)[-1][:12])

    def start(trigger):
        return app.start(spark, settings, source="files", path=replay.stage_path,
                         analytics_sink=versioned_writer(f"{root}/stats"), trigger=trigger)

    # Slices in time order: both queries keep running while slices arrive, then one closing run.
    running = start(None)
    try:
        for k in range(len(replay.bounds())):
            replay.stage(k)
            for q in running.queries():
                q.processAllAvailable()
    finally:
        running.stop()
    for q in start({"availableNow": True}).queries():
        sq.drain(q)
    _forget(spark, root)
    return settings, root


def stream_app_storage(spark: SparkSession, sf: str) -> DataFrame:
    """What the application's storage query wrote, read through its catalog table."""
    settings, _ = _app_run(spark, sf)
    stored = read_table(spark, catalog.TableRef(settings.database, settings.table).sql)
    return stored.select("symbol", "coin_name", "category", "price",
                         F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def stream_app_window_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The application's windowed statistics (update mode): last update per window and key."""
    _, root = _app_run(spark, sf)
    return _statistics(latest_updates(spark, f"{root}/stats", ["window_start", "window_end", *STAT_KEYS]))


_APP_TICKS = ("SELECT event_type AS symbol, upper(event_type) AS coin_name, "
              "'kind-' || CAST(length(event_type) AS VARCHAR) AS category, value AS price, ts AS timestamp "
              "FROM events")


def _late_sql() -> str:
    # The slice edges in epoch microseconds, computed as the replay computes them.
    span = "(SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) - min(epoch_us(ts)) + 1 AS span FROM events)"
    s3 = f"(SELECT lo + (span * 3) // 5 FROM {span} b)"
    s4 = f"(SELECT lo + (span * 4) // 5 FROM {span} b)"
    kept = (f"SELECT * FROM ({_ENRICHED}) x WHERE epoch_us(x.timestamp) < {s3} "
            f"OR epoch_us(x.timestamp) >= {s4}")
    return _stats_sql("2 seconds", "symbol, coin_name, category", kept)


def _append_sql() -> str:
    # Spark keeps the watermark in milliseconds: newest event time (ms) minus the 2 s delay.
    closed = ("SELECT * FROM ({stats}) s WHERE epoch_ms(window_end) <= "
              "(SELECT epoch_ms(max(ts)) - 2000 FROM events)")
    return closed.format(stats=BATCH_SQL["window_stats_from_messages"])


QUERIES = {
    "stream_window_stats": stream_window_stats,
    "stream_window_stats_append": stream_window_stats_append,
    "stream_late_rows": stream_late_rows,
    "stream_raw_store": stream_raw_store,
    "stream_flat_store": stream_flat_store,
    "stream_file_count": stream_file_count,
    "stream_empty_batches": stream_empty_batches,
    "stream_flat_files": stream_flat_files,
    "stream_app_storage": stream_app_storage,
    "stream_app_window_stats": stream_app_window_stats,
}

ORACLE_SQL = {
    "stream_window_stats": BATCH_SQL["window_stats_from_messages"],
    "stream_window_stats_append": _append_sql(),
    "stream_late_rows": _late_sql(),
    "stream_raw_store": _ENRICHED,
    "stream_flat_store": _ENRICHED,
    "stream_file_count": "SELECT count(DISTINCT CAST(ts AS DATE)) AS file_count FROM events",
    "stream_empty_batches": "SELECT CAST(0 AS BIGINT) AS files_after_empty, count(*) AS stored_rows FROM events",
    "stream_flat_files": "SELECT CAST(0 AS BIGINT) AS other_entries, count(*) AS stored_rows FROM events",
    "stream_app_storage": _APP_TICKS,
    "stream_app_window_stats": _stats_sql("2 seconds", "symbol, coin_name, category", _APP_TICKS),
}
