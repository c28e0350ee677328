"""Registered queries of the durable streaming parts: commit log, versioned dimension, rejects, late rows, state,
rollups, tiers, zones, hot keys, event cap, snapshots and chained queries.

As in ``registered`` each replays the shared tables slice by slice through the real plan and returns a batch
DataFrame over what was stored. Where the point is a crash, one is injected and the query restarted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.config import scratch_path, use_utc
from tickwise.functions import snapshot
from tickwise.functions.parse import counted, parse_ticks, split_messages
from tickwise.plans import registered as batch
from tickwise.sources import tables
from tickwise.sources.files import replay_stream
from tickwise.sources.fs import delete_path
from tickwise.streaming import queries as sq
from tickwise.streaming.cap import EventCap
from tickwise.streaming.dimension import VersionedDimension
from tickwise.streaming.flat_log import FlatLog
from tickwise.streaming.heavy import HeavyHitters
from tickwise.streaming.late import LateLedger
from tickwise.streaming.registered import (LATE_ORDER, MESSAGE, SLICES, STAT_KEYS, _enriched_stream, _replay, _statistics,
                                           _stored)
from tickwise.streaming.replay import SliceReplay
from tickwise.streaming.rollup import RollupTable
from tickwise.streaming.sinks import fan_out, latest_updates, split_writer, versioned_writer
from tickwise.streaming.state import open_windows
from tickwise.streaming.tiers import TieredLog

REQUIRED = ("symbol", "price", "timestamp")
NOW = {"availableNow": True}


def _parsed_stream(spark: SparkSession, stage: str) -> DataFrame:
    raw = replay_stream(spark, stage, "text").withColumnRenamed("value", "json")
    return parse_ticks(raw, schema=MESSAGE, required=REQUIRED)


def _each_batch(stream: DataFrame, checkpoint: str, write: Callable, name: str):
    """Starts the query that hands every micro-batch to ``write``."""
    return lambda trigger=NOW: (stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
                                .foreachBatch(write).trigger(**trigger).start())


class _Crash:
    """Raises once for each of some batches, as a lost driver would end the query there."""

    MARK = "injected crash"

    def __init__(self, *batches: int):
        self.left = set(batches)

    def __call__(self, batch_id: int) -> None:
        if batch_id in self.left:
            self.left.remove(batch_id)
            raise RuntimeError(f"{self.MARK} in batch {batch_id}")


def _drain(start: Callable) -> None:
    """Run to the end, restarting from the checkpoint after an injected crash."""
    while True:
        try:
            sq.drain(start())
            return
        except Exception as error:  # noqa: BLE001 - only the injected crash is survived
            if _Crash.MARK not in str(error):
                raise


def _ticks(df: DataFrame) -> DataFrame:
    return df.select("symbol", "price", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "user_id", "event_id")


# -- flat storage, once ------------------------------------------------------------------------------------

def stream_flat_once(spark: SparkSession, sf: str) -> DataFrame:
    """Flat storage with crashes between the writing and the commit of two batches: every row once, read as a
    plain folder."""
    use_utc(spark)
    root = scratch_path(spark, "stream_flat_once")
    replay = _replay(spark, sf, root)
    log, crash = FlatLog(f"{root}/table", f"{root}/checkpoint/files", compact_every=2), _Crash(1, 3)
    start = _each_batch(_enriched_stream(spark, sf, replay.stage_path), f"{root}/checkpoint",
                        log.writer(before_commit=crash), "flat_once")
    for k in LATE_ORDER:
        replay.stage(k)
        _drain(start)
    return _stored(spark.read.parquet(f"{root}/table"))


def _sliced_log(spark: SparkSession, sf: str) -> tuple[FlatLog, DataFrame]:
    """The ticks stored in a flat folder by five batches, and one of them."""
    use_utc(spark)
    root = scratch_path(spark, "zones")
    ticks = tables.ticks(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    replay = SliceReplay(ticks, "timestamp", f"{root}/stage", [], "text", SLICES)
    log = FlatLog(f"{root}/table", f"{root}/log", compact_every=3)
    for k, (low, high) in enumerate(replay.bounds()):
        micros = F.unix_micros("timestamp")
        log.write(ticks.where((micros >= low) & (micros < high)), k)
    return log, ticks


def zone_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Row count and time range of the stored table, from the zones written at commit."""
    log, _ = _sliced_log(spark, sf)
    return log.totals(spark).withColumns({c: F.col(c).cast("timestamp_ntz") for c in
                                          ("first_event_timestamp", "latest_event_timestamp")})


def zone_rows_by_symbol(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per symbol, from the zones."""
    return _sliced_log(spark, sf)[0].rows_by_key(spark)


def zone_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 20 ticks; files too old to hold one are not opened."""
    log, ticks = _sliced_log(spark, sf)
    return _ticks(log.newest(spark, ticks.schema, 20, ("timestamp", "event_id")))


# -- dimension versions and chained queries ----------------------------------------------------------------

def _write_dimension(spark: SparkSession, sf: str, path: str, k: int) -> None:
    """The metadata file as it is when slice k arrives: it gains, loses and changes rows; before slice 2 it repeats
    its keys, before slice 3 it is gone (both must be refused)."""
    if k == 3:
        delete_path(spark, path)
        return
    symbols = tables.load(spark, sf, "events").select(F.col("event_type").alias("symbol")).distinct()
    rows = symbols.select("symbol", F.concat(F.upper("symbol"), F.lit(f" v{k}")).alias("coin_name"),
                          F.concat(F.lit("kind-"), F.length("symbol").cast("string")).alias("category"))
    if k == 0:
        rows = rows.where("symbol <> 'purchase'")
    elif k == 1:
        rows = rows.where("symbol <> 'click'")
    elif k == 2:
        rows = rows.unionByName(rows)
    rows.write.mode("overwrite").option("header", True).csv(path)


def stream_dimension_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched storage while the metadata file changes between slices, with one crash: each slice has the names of
    the version of its time."""
    use_utc(spark)
    root = scratch_path(spark, "stream_dimension")
    replay = _replay(spark, sf, root)
    dimension = VersionedDimension(f"{root}/metadata.csv", f"{root}/checkpoint/dimension")
    log, crash = FlatLog(f"{root}/table", f"{root}/checkpoint/files"), _Crash(1)
    start = _each_batch(_parsed_stream(spark, replay.stage_path), f"{root}/checkpoint",
                        dimension.joined(log.writer(before_commit=crash)), "dimension_versions")
    for k in range(SLICES):
        _write_dimension(spark, sf, f"{root}/metadata.csv", k)
        replay.stage(k)
        _drain(start)
    rows = spark.read.parquet(f"{root}/table")
    return rows.select("symbol", "coin_name", "category", "price", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                       "event_id")


def stream_chained_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Window statistics that follow the stored table as a stream: the messages are read by the storage query alone."""
    use_utc(spark)
    root = scratch_path(spark, "stream_chained")
    replay = _replay(spark, sf, root)
    stream = _enriched_stream(spark, sf, replay.stage_path)
    log = FlatLog(f"{root}/table", f"{root}/checkpoint/files")
    chained = sq.stored_stream(spark, f"{root}/table", stream.schema)
    for k in range(SLICES):
        replay.stage(k)
        sq.drain(sq.raw_storage_query(stream, f"{root}/table", f"{root}/checkpoint", exactly_once=False, trigger=NOW, log=log))
        sq.drain(sq.window_stats_query(chained, f"{root}/stats-checkpoint", versioned_writer(f"{root}/stats"), "2 seconds",
                                       "2 seconds", STAT_KEYS, trigger=NOW))
    return _statistics(latest_updates(spark, f"{root}/stats", ["window_start", "window_end", *STAT_KEYS]))


def stream_hot_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """A third of all ticks are one user's and the dimension may not be broadcast: users that the running sketch
    calls hot are joined apart."""
    use_utc(spark)
    root = scratch_path(spark, "stream_hot")
    tables.dimension(spark, sf).write.parquet(f"{root}/dimension")
    replay = SliceReplay(tables.id_messages(spark, sf, hot_user=True), "ts", f"{root}/stage", ["json"], "text", SLICES)
    dimension = VersionedDimension(f"{root}/dimension", f"{root}/checkpoint/dimension", key="user_id",
                                   read=lambda s, path: s.read.parquet(path), max_rows=0)
    log = FlatLog(f"{root}/table", f"{root}/checkpoint/files")
    start = _each_batch(_parsed_stream(spark, replay.stage_path), f"{root}/checkpoint",
                        dimension.joined(log.writer(), HeavyHitters(f"{root}/checkpoint/heavy", "user_id")), "hot_key_join")
    replay.run(start)
    return _stored(spark.read.parquet(f"{root}/table"))


# -- rejects, late rows, open windows ----------------------------------------------------------------------

def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged messages parsed once into ticks and rejects with a reason, both stored: messages per outcome."""
    use_utc(spark)
    root = scratch_path(spark, "stream_rejects")
    replay = SliceReplay(tables.damaged_messages(spark, sf, keep=("event_id", "ts")), "ts", f"{root}/stage", ["json"],
                         "text", SLICES)
    raw = replay_stream(spark, replay.stage_path, "text").withColumnRenamed("value", "json")
    ticks = FlatLog(f"{root}/ticks", f"{root}/checkpoint/ticks")
    rejects = FlatLog(f"{root}/rejects", f"{root}/checkpoint/rejects", key=None)
    replay.run(_each_batch(counted(split_messages(raw)), f"{root}/checkpoint",
                           split_writer(ticks.writer(), rejects.writer()), "rejects"))
    bad = spark.read.parquet(f"{root}/rejects").groupBy(F.col("reject_reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"))
    good = spark.read.parquet(f"{root}/ticks").agg(F.count(F.lit(1)).alias("messages"))
    return bad.unionByName(good.select(F.lit("accepted").alias("outcome"), "messages"))


def stream_late_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The ticks that the windowed query dropped when slice 3 came after slice 4."""
    use_utc(spark)
    root = scratch_path(spark, "stream_late")
    replay = _replay(spark, sf, root)
    stream = _enriched_stream(spark, sf, replay.stage_path)

    def parse(lines: DataFrame) -> DataFrame:
        return parse_ticks(lines.withColumnRenamed("value", "json"), schema=MESSAGE, required=REQUIRED)

    ledger = LateLedger(f"{root}/checkpoint", f"{root}/late", parse)
    for k in LATE_ORDER:
        replay.stage(k)
        query = sq.window_stats_query(stream, f"{root}/checkpoint", versioned_writer(f"{root}/stats"), "2 seconds",
                                      "2 seconds", STAT_KEYS, trigger=NOW)
        sq.drain(query)
        ledger.collect(spark, [p if isinstance(p, dict) else p.__dict__ for p in query.recentProgress])
    return _ticks(ledger.read(spark, MESSAGE))


def stream_open_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Append mode: the windows it emitted, and those still open in its state after a restart."""
    use_utc(spark)
    root = scratch_path(spark, "stream_open")
    replay = _replay(spark, sf, root)
    stream = _enriched_stream(spark, sf, replay.stage_path)
    replay.run_live(lambda trigger: sq.window_stats_query(
        stream, f"{root}/checkpoint", versioned_writer(f"{root}/stats"), "2 seconds", "2 seconds", STAT_KEYS,
        output_mode="append", trigger=trigger))
    emitted = _statistics(spark.read.parquet(f"{root}/stats")).withColumn("open", F.lit(False))
    held = _statistics(open_windows(spark, f"{root}/checkpoint", STAT_KEYS)).withColumn("open", F.lit(True))
    return emitted.unionByName(held)


# -- rollups, tiers, caps ----------------------------------------------------------------------------------

def _rollup(width: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        use_utc(spark)
        root = scratch_path(spark, "rollup")
        replay = _replay(spark, sf, root)
        table, crash = RollupTable(f"{root}/table"), _Crash(1, 4)

        def write(ticks: DataFrame, batch_id: int) -> None:
            table.write(ticks, batch_id)
            crash(batch_id)  # merged, but the query has not noted it: the batch comes again

        start = _each_batch(_parsed_stream(spark, replay.stage_path), f"{root}/checkpoint", write, "rollup")
        for k in LATE_ORDER:
            replay.stage(k)
            _drain(start)
        found = table.rollup(spark, width)
        return found.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                            F.col("window_end").cast("timestamp_ntz").alias("window_end"), "symbol",
                            F.round("average_price", batch.ROUND).alias("average_price"), "max_price", "min_price", "event_count")

    run.__doc__ = f"Statistics per {width} from 2-second states merged batch by batch, out of order and with replays."
    return run


def stream_tiered_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Update-mode statistics kept in a tiered log: last update per window and key."""
    use_utc(spark)
    root = scratch_path(spark, "stream_tiers")
    replay = _replay(spark, sf, root)
    stream = _enriched_stream(spark, sf, replay.stage_path)
    log = TieredLog(f"{root}/log", ["window_start", "window_end", *STAT_KEYS], fan_in=2)
    replay.run(lambda: sq.window_stats_query(stream, f"{root}/checkpoint", log.write, "2 seconds", "2 seconds", STAT_KEYS,
                                             trigger=NOW))
    return _statistics(log.latest(spark))


def stream_capped_events(spark: SparkSession, sf: str) -> DataFrame:
    """A total cap of half the events over several triggers and restarts: exactly the first half is stored."""
    use_utc(spark)
    root = scratch_path(spark, "stream_cap")
    replay = _replay(spark, sf, root)
    cap = EventCap(tables.load(spark, sf, "events").count() // 2, f"{root}/checkpoint/cap")
    log, crash = FlatLog(f"{root}/table", f"{root}/checkpoint/files"), _Crash(1)
    start = _each_batch(_parsed_stream(spark, replay.stage_path), f"{root}/checkpoint",
                        cap.capped(log.writer(before_commit=crash)), "capped")
    for k in range(SLICES):
        replay.stage(k)
        _drain(start)
    return _ticks(spark.read.parquet(f"{root}/table"))


# -- snapshots ---------------------------------------------------------------------------------------------

def _snapshot_run(spark: SparkSession, sf: str) -> str:
    """Snapshots as a stream, shaped once per row into ticks and rejects, both stored."""
    use_utc(spark)
    root = scratch_path(spark, "stream_snapshots")
    source = tables.snapshots(spark, sf)
    replay = SliceReplay(source, "fetched_at", f"{root}/stage", source.columns, "parquet", SLICES)
    stream = replay_stream(spark, replay.stage_path, "parquet", source.schema)
    split = snapshot.snapshot_split(stream, batch.SNAPSHOT_ASSETS, keep=("snapshot_id",))
    ticks = FlatLog(f"{root}/ticks", f"{root}/checkpoint/ticks")
    rejects = FlatLog(f"{root}/rejects", f"{root}/checkpoint/rejects", key=None)
    write = fan_out((lambda s: snapshot.ticks_of(s, ("snapshot_id",)).drop("price_text"), ticks.writer()),
                    (lambda s: snapshot.rejects_of(s, keep=("snapshot_id",)), rejects.writer()))
    replay.run(_each_batch(split, f"{root}/checkpoint", write, "snapshots"))
    return root


def stream_snapshot_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_snapshot_run(spark, sf)}/ticks").select("snapshot_id", "symbol", "price", "timestamp")


def stream_snapshot_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_snapshot_run(spark, sf)}/rejects").select("snapshot_id", "status", "reason")


QUERIES = {
    "stream_flat_once": stream_flat_once,
    "zone_totals": zone_totals,
    "zone_rows_by_symbol": zone_rows_by_symbol,
    "zone_newest": zone_newest,
    "stream_dimension_versions": stream_dimension_versions,
    "stream_chained_stats": stream_chained_stats,
    "stream_hot_key_join": stream_hot_key_join,
    "stream_rejects": stream_rejects,
    "stream_late_ledger": stream_late_ledger,
    "stream_open_windows": stream_open_windows,
    "rollup_40s": _rollup("40 seconds"),
    "rollup_1h": _rollup("1 hour"),
    "stream_tiered_updates": stream_tiered_updates,
    "stream_capped_events": stream_capped_events,
    "stream_snapshot_ticks": stream_snapshot_ticks,
    "stream_snapshot_rejects": stream_snapshot_rejects,
}

# The slice of a tick, by the edges in epoch microseconds that the replay computes.
_EDGE = "(SELECT min(epoch_us(ts)) + ((max(epoch_us(ts)) - min(epoch_us(ts)) + 1) * {k}) // 5 FROM events)"
_SLICE = "(" + " + ".join(f"CAST(epoch_us(timestamp) >= {_EDGE.format(k=k)} AS INTEGER)" for k in range(1, 5)) + ")"
_SLICED = f"SELECT *, {_SLICE} AS slice FROM ({batch._TICKS}) t"
_STATS = batch.ORACLE_SQL["window_stats_from_messages"]

ORACLE_SQL = {
    "stream_flat_once": batch._ENRICHED,
    "zone_totals": ("SELECT count(*) AS record_count, min(ts) AS first_event_timestamp, max(ts) AS latest_event_timestamp "
                    "FROM events"),
    "zone_rows_by_symbol": "SELECT event_type AS symbol, count(*) AS count FROM events GROUP BY event_type",
    "zone_newest": f"SELECT * FROM ({batch._TICKS}) t ORDER BY timestamp DESC, event_id DESC LIMIT 20",
    # Slices 2 and 3 keep the version of slice 1: what came for them was refused.
    "stream_dimension_versions": (
        "SELECT symbol, price, timestamp, event_id, CASE WHEN known THEN upper(symbol) || ' v' || version END AS coin_name, "
        "CASE WHEN known THEN 'kind-' || length(symbol) END AS category "
        "FROM (SELECT *, NOT (version = 0 AND symbol = 'purchase' OR version = 1 AND symbol = 'click') AS known "
        f"FROM (SELECT *, CASE WHEN slice IN (2, 3) THEN 1 ELSE slice END AS version FROM ({_SLICED}) s) v) k"),
    "stream_chained_stats": _STATS,
    "stream_hot_key_join": (f"SELECT t.user_id, d.coin_name, d.category, t.event_id, t.symbol, t.price, t.timestamp "
                            f"FROM ({batch._HOT_TICKS}) t LEFT JOIN ({batch._DIM}) d ON t.user_id = d.user_id"),
    "stream_rejects": (f"SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS messages "
                       f"FROM ({batch.REJECTS_SQL}) r GROUP BY outcome"),
    "stream_late_ledger": f"SELECT * EXCLUDE (slice) FROM ({_SLICED}) s WHERE slice = 3",
    "stream_open_windows": (f"SELECT *, epoch_ms(window_end) > (SELECT epoch_ms(max(ts)) - 2000 FROM events) AS open "
                            f"FROM ({_STATS}) s"),
    "rollup_40s": batch._stats_sql("40 seconds", "symbol", batch._TICKS),
    "rollup_1h": batch._stats_sql("1 hour", "symbol", batch._TICKS),
    "stream_tiered_updates": _STATS,
    "stream_capped_events": (f"SELECT * FROM ({batch._TICKS}) t QUALIFY row_number() OVER (ORDER BY timestamp, symbol) "
                             "<= (SELECT count(*) // 2 FROM events)"),
    "stream_snapshot_ticks": batch.ORACLE_SQL["snapshot_ticks"],
    "stream_snapshot_rejects": batch.ORACLE_SQL["snapshot_rejects"],
}
