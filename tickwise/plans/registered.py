"""Registered queries over the shared tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole tables. Timestamps leave
as TIMESTAMP_NTZ (UTC wall clock), counts as BIGINT, averages rounded to 6 places; every output column is
named the same in the Spark plan and in its SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.config import Settings, scratch_path, use_utc
from tickwise.functions import encode, parse, snapshot
from tickwise.operators import enrich as enrich_op
from tickwise.operators import grid, latest, summary, windows
from tickwise.plans import catalog, dashboard, ingest, inspection
from tickwise.schemas import ENRICHED_FIELDS
from tickwise.sources import tables
from tickwise.sources.files import read_metadata
from tickwise.sources.fs import delete_path

ROUND = 6
# Asset list of the snapshot queries: three event types are quoted assets, one of them under two symbols,
# "refund" never occurs, the other event types and "tether" are not configured.
SNAPSHOT_ASSETS = (("click", "CLK"), ("click", "TAP"), ("purchase", "PUR"), ("view", "VEW"), ("refund", "RFD"))

Query = Callable[[SparkSession, str], DataFrame]


def _ticks(spark, sf):
    use_utc(spark)
    return tables.ticks(spark, sf)


def _enriched(spark, sf):
    """Ticks left-joined to the dimension; every fifth tick's user is unknown and stays unmatched."""
    return enrich_op.enrich(_ticks(spark, sf), tables.dimension(spark, sf), key="user_id")


def _stats(width, keys=("symbol",), drop_unmatched=False, enriched=False):
    def run(spark, sf):
        src = _enriched(spark, sf) if enriched else _ticks(spark, sf)
        return windows.window_stats(src, width, keys, drop_unmatched=drop_unmatched,
                                    round_average=ROUND)
    return run


def _hot_key_ticks(spark, sf):
    """Ticks where every third event belongs to one user (key 1): a key holding a third of all rows."""
    t = _ticks(spark, sf)
    return t.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))


def hot_key_enrich_stats(spark, sf):
    """Enrichment forced through the shuffle join (the path for a dimension too large to broadcast), then
    hourly statistics per user: the hot key is found by counting and joined apart."""
    dim = tables.dimension(spark, sf)
    enriched = enrich_op.enrich(_hot_key_ticks(spark, sf), dim, key="user_id", broadcast=False)
    return windows.window_stats(enriched, "1 hour", ("user_id", "coin_name", "category"),
                                round_average=ROUND)


def window_stats_from_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming job's plan in batch: JSON messages -> strict parse -> enrich -> 2-second stats."""
    use_utc(spark)
    msgs = tables.tick_messages(spark, sf)
    parsed = parse.parse_ticks(msgs, keep=("event_id", "user_id"))
    ticks = parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    dim = tables.dimension(spark, sf)
    enriched = enrich_op.enrich(ticks, dim, key="user_id")
    return windows.window_stats(enriched, "2 seconds", ("symbol", "coin_name", "category"),
                                round_average=ROUND)


def _enrich_winners(spark, sf, winners: DataFrame) -> DataFrame:
    """Enrich a handful of selected ticks. The dimension key is unique, so picking rows first and joining
    afterwards gives the same rows as joining every tick first, with a join over the winners only."""
    dim = tables.dimension(spark, sf)
    return enrich_op.enrich(winners, dim, key="user_id")


def latest_per_symbol(spark, sf):
    winners = latest.latest_per_key(_ticks(spark, sf), "symbol", order=("timestamp", "event_id"))
    return _enrich_winners(spark, sf, winners)


def latest_per_symbol_ties(spark, sf):
    """Event times cut to the day, so that many ticks of a symbol tie: still one row per symbol."""
    day = F.date_trunc("day", F.col("timestamp")).cast("timestamp_ntz")
    ticks = _enriched(spark, sf).withColumn("timestamp", day)
    winners = latest.latest_per_key(ticks, "symbol", order=("timestamp",), columns=["coin_name", "price", "timestamp"])
    # Which of the tied rows it is follows from a hash; that it is one of them is checked here.
    tied = winners.join(ticks.select("symbol", "timestamp", "price", "coin_name").distinct(), ["symbol", "timestamp"], "left_semi")
    return tied.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("timestamp"))


def last_price_40s(spark, sf):
    return latest.last_in_bucket(_ticks(spark, sf), "40 seconds", "symbol", "price",
                                 tie_breakers=("event_id",))


def latest_bucket_per_symbol(spark, sf):
    # The newest bucket is the bucket of the newest tick: one max per symbol, no per-bucket aggregation.
    return grid.chart_frames(_ticks(spark, sf)).select("symbol", "latest_bucket")


def dense_trend_grid(spark, sf):
    return grid.dense_trend_grid(_ticks(spark, sf), tie_breakers=("event_id",))


def trend_points_non_null(spark, sf):
    return grid.dense_trend_grid(_ticks(spark, sf), tie_breakers=("event_id",), only_priced=True)


def enrich_left(spark, sf):
    return _enriched(spark, sf)


def dashboard_analytics_2s(spark, sf):
    return windows.bucket_stats(_enriched(spark, sf), "2 seconds", round_average=ROUND)


def json_round_trip(spark, sf):
    use_utc(spark)
    parsed = parse.parse_ticks(tables.tick_messages(spark, sf), keep=("event_id",))
    return parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def parse_damaged(spark, sf):
    use_utc(spark)
    parsed = parse.parse_ticks(tables.damaged_messages(spark, sf), keep=("event_id",))
    return parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def parse_rejects(spark, sf):
    """The messages that the strict parse rejects, with the reason, from the same single parse."""
    use_utc(spark)
    split = parse.split_messages(tables.damaged_messages(spark, sf), keep=("event_id",))
    return parse.rejected(split, ("event_id",)).select("event_id", "reject_reason")


def parse_outcomes(spark, sf):
    """Messages, ticks and rejects of one parse: every message is one or the other."""
    use_utc(spark)
    split = parse.split_messages(tables.damaged_messages(spark, sf), keep=("event_id",))
    good = F.col("reject_reason").isNull()
    return split.agg(F.count(F.lit(1)).alias("messages"), F.count_if(good).alias("ticks"), F.count_if(~good).alias("rejects"))


def kafka_payload(spark, sf):
    use_utc(spark)
    return encode.kafka_records(_ticks(spark, sf), keep=("event_id",))


def lenient_normalise(spark, sf):
    use_utc(spark)
    return parse.normalize_prices(tables.loose_feed(spark, sf))


def snapshot_ticks(spark, sf):
    use_utc(spark)
    return snapshot.snapshot_ticks(tables.snapshots(spark, sf), SNAPSHOT_ASSETS, keep=("snapshot_id",))


def snapshot_rejects(spark, sf):
    use_utc(spark)
    return snapshot.snapshot_rejects(tables.snapshots(spark, sf), SNAPSHOT_ASSETS, keep=("snapshot_id",))


def snapshot_payload(spark, sf):
    """Kafka records of the snapshots' ticks, prices on the wire as they were quoted."""
    use_utc(spark)
    return ingest.shape(tables.snapshots(spark, sf), SNAPSHOT_ASSETS, keep=("snapshot_id",)).records


def fetch_time_stamped(spark, sf):
    """Ticks of snapshots without a recorded fetch time: how many carry the current one."""
    use_utc(spark)
    stamped = ingest.with_fetch_time(tables.snapshots(spark, sf).drop("fetched_at"))
    ticks = snapshot.snapshot_ticks(stamped, SNAPSHOT_ASSETS)
    fresh = F.col("timestamp") >= F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return ticks.agg(F.count(F.when(fresh, 1)).alias("stamped_ticks"))


def bytes_to_ticks(spark, sf):
    """Messages as the bytes a topic holds -> text -> strict parse."""
    use_utc(spark)
    raw = tables.tick_messages(spark, sf).select(F.col("json").cast("binary").alias("value"))
    parsed = parse.parse_ticks(parse.bytes_to_text(raw))
    return parsed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def enrich_missing_metadata(spark, sf):
    """Enrichment with a metadata file that does not exist: every tick kept, names null."""
    metadata = read_metadata(spark, f"{scratch_path(spark, 'metadata')}/missing.csv")
    return enrich_op.enrich(_ticks(spark, sf), metadata, key="symbol")


def enrich_replaces_columns(spark, sf):
    """Enrichment of ticks that already carry descriptive columns: those are replaced."""
    stale = _ticks(spark, sf).withColumns({"coin_name": F.lit("old"), "category": F.lit("old")})
    return enrich_op.enrich(stale, tables.dimension(spark, sf), key="user_id")


def rows_by_symbol(spark, sf):
    # A left join on a unique key neither adds nor removes ticks: count the ticks directly.
    return summary.rows_by_key(_ticks(spark, sf), ("symbol",))


def rows_by_symbol_name_category(spark, sf):
    return summary.rows_by_key(_enriched(spark, sf))


def time_range(spark, sf):
    return summary.time_range(_ticks(spark, sf))


def row_count(spark, sf):
    return summary.row_count(_ticks(spark, sf))


def distinct_symbols(spark, sf):
    return summary.distinct_values(_ticks(spark, sf), "symbol")


def newest_n(spark, sf):
    winners = summary.newest(_ticks(spark, sf), 20, order=("timestamp", "event_id"))
    return summary.newest(_enrich_winners(spark, sf, winners), 20, order=("timestamp", "event_id"))


def symbol_slice(spark, sf):
    return summary.key_slice(_enriched(spark, sf), "purchase")


def sample_10(spark, sf):
    """How many rows an unordered sample of ten has (which rows is undefined)."""
    return summary.row_count(summary.sample_rows(_ticks(spark, sf), 10), "sample_rows")


def key_profile(spark, sf):
    return summary.key_profile(_enriched(spark, sf))


def _dashboard(spark, sf) -> dashboard.DashboardFrames:
    """The dashboard plan over the loosely typed text feed (no metadata file: names stay empty)."""
    use_utc(spark)
    return dashboard.build(tables.loose_feed(spark, sf), tie_breakers=("event_id",))


def dashboard_latest(spark, sf):
    return _dashboard(spark, sf).latest


def dashboard_trends(spark, sf):
    return _dashboard(spark, sf).trends


def dashboard_grid(spark, sf):
    return _dashboard(spark, sf).grid


def _topic(spark, sf) -> dashboard.DashboardFrames:
    """The dashboard over JSON messages, some damaged, some with their price as text, wider buckets."""
    use_utc(spark)
    settings = Settings(window_width="10 seconds", trend_bucket_seconds=60)
    return dashboard.from_messages(tables.damaged_messages(spark, sf), settings=settings, tie_breakers=("event_id",))


def dashboard_topic_latest(spark, sf):
    return _topic(spark, sf).latest


def dashboard_topic_analytics(spark, sf):
    return _topic(spark, sf).analytics.withColumn("average_price", F.round("average_price", ROUND))


def dashboard_topic_trends(spark, sf):
    return _topic(spark, sf).trends


def _stored(spark, sf) -> str:
    """The enriched ticks as a flat Parquet folder, stored anew by every query that reads it."""
    use_utc(spark)
    path = scratch_path(spark, "stored_table")
    rows = _enriched(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows.select(*ENRICHED_FIELDS).write.mode("append").parquet(path)
    return path


def _inspected(spark, sf) -> inspection.InspectionReport:
    """The inspection report over the stored folder."""
    path = _stored(spark, sf)
    settings = Settings(database="tickwise_inspect", table="ticks_" + path.rsplit("/", 1)[-1][:12], output_path=path)
    return inspection.inspect(spark, settings)


def folder_latest(spark, sf):
    """The dashboard's latest ticks over the stored Parquet folder."""
    latest_rows = dashboard.from_parquet(spark, Settings(output_path=_stored(spark, sf))).latest
    return _ntz(latest_rows, "timestamp")


def missing_folder(spark, sf):
    """The dashboard over the stored folder and over one that does not exist: rows of each."""
    here = dashboard.from_parquet(spark, Settings(output_path=_stored(spark, sf))).prices
    none = dashboard.from_parquet(spark, Settings(output_path=scratch_path(spark, "nowhere"))).prices
    return here.agg(F.count(F.lit(1)).alias("stored_rows")).crossJoin(none.agg(F.count(F.lit(1)).alias("missing_rows")))


def compacted_table(spark, sf):
    """Enriched ticks appended as many small files (as micro-batches leave them), compacted into large
    time-ordered files in a new folder, read back."""
    root = scratch_path(spark, "compaction")
    _enriched(spark, sf).write.option("maxRecordsPerFile", 20_000).mode("append").parquet(f"{root}/small")
    out = catalog.compact(spark, f"{root}/small", f"{root}/compacted")
    delete_path(spark, f"{root}/small")
    return out


def compacted_days(spark, sf):
    """The same with one folder per event day."""
    root = scratch_path(spark, "compaction")
    _enriched(spark, sf).write.option("maxRecordsPerFile", 20_000).mode("append").parquet(f"{root}/small")
    out = catalog.compact(spark, f"{root}/small", f"{root}/compacted", partition_by_day=True)
    delete_path(spark, f"{root}/small")
    return out


def listed_tables(spark, sf):
    """What SHOW DATABASES, SHOW TABLES and COUNT(*) say about the registered table."""
    report = _inspected(spark, sf)
    database, table = (x.strip("`") for x in report.table.split("."))
    databases = catalog.show_databases(spark).where(F.col("namespace") == database)
    listed = catalog.show_tables(spark, database).where(F.col("tableName") == table)
    rows = spark.sql(f"SELECT COUNT(*) AS record_count FROM {report.table}")
    return (databases.agg(F.count(F.lit(1)).alias("databases")).crossJoin(listed.agg(F.count(F.lit(1)).alias("listed")))
            .crossJoin(rows))


def cleared_table(spark, sf):
    """A stored copy of the ticks, cleared through the catalog: rows before and after."""
    use_utc(spark)
    path = scratch_path(spark, "cleared")
    _ticks(spark, sf).select("symbol", "price", "timestamp").write.parquet(path)
    name = catalog.register_table(spark, "tickwise_clear", "ticks_" + path.rsplit("/", 1)[-1][:12], path,
                                  columns_ddl="symbol STRING, price DOUBLE, timestamp TIMESTAMP_NTZ")
    before = spark.table(name).count()
    catalog.clear_location(spark, path, name)
    after = spark.table(name).agg(F.count(F.lit(1)).alias("rows_after"))
    return after.select(F.lit(before).cast("long").alias("rows_before"), "rows_after")


def capped_events_half(spark, sf):
    """The earliest half of all ticks by (time, symbol)."""
    ticks = _ticks(spark, sf)
    return ingest.cap_events(ticks, ticks.count() // 2, order=("timestamp", "symbol"))


def capped_events_small(spark, sf):
    """The earliest hundred ticks, through the same path."""
    return ingest.cap_events(_ticks(spark, sf), 100, order=("timestamp", "symbol"))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def inspection_row_count(spark, sf):
    return _inspected(spark, sf).frames["row_count"]


def inspection_time_range(spark, sf):
    return _ntz(_inspected(spark, sf).frames["time_range"], "first_event_timestamp",
                "latest_event_timestamp")


def inspection_rows_by_symbol(spark, sf):
    return _inspected(spark, sf).frames["rows_by_symbol"]


def inspection_recent_sample(spark, sf):
    return _ntz(_inspected(spark, sf).frames["recent_sample"], "timestamp")


QUERIES: dict[str, Query] = {
    "window_stats_from_messages": window_stats_from_messages,
    "window_stats_2s": _stats("2 seconds"),
    "window_stats_1h": _stats("1 hour"),
    "stats_keep_unmatched": _stats("1 hour", ("user_id", "coin_name", "category"), enriched=True),
    "stats_drop_unmatched": _stats("1 hour", ("user_id", "coin_name", "category"), True, enriched=True),
    "dashboard_analytics_2s": dashboard_analytics_2s,
    "hot_key_enrich_stats": hot_key_enrich_stats,
    "latest_per_symbol": latest_per_symbol,
    "latest_per_symbol_ties": latest_per_symbol_ties,
    "last_price_40s": last_price_40s,
    "latest_bucket_per_symbol": latest_bucket_per_symbol,
    "dense_trend_grid": dense_trend_grid,
    "trend_points_non_null": trend_points_non_null,
    "enrich_left": enrich_left,
    "json_round_trip": json_round_trip,
    "parse_damaged": parse_damaged,
    "parse_rejects": parse_rejects,
    "parse_outcomes": parse_outcomes,
    "kafka_payload": kafka_payload,
    "lenient_normalise": lenient_normalise,
    "snapshot_ticks": snapshot_ticks,
    "snapshot_rejects": snapshot_rejects,
    "snapshot_payload": snapshot_payload,
    "fetch_time_stamped": fetch_time_stamped,
    "bytes_to_ticks": bytes_to_ticks,
    "enrich_missing_metadata": enrich_missing_metadata,
    "enrich_replaces_columns": enrich_replaces_columns,
    "rows_by_symbol": rows_by_symbol,
    "rows_by_symbol_name_category": rows_by_symbol_name_category,
    "time_range": time_range,
    "row_count": row_count,
    "distinct_symbols": distinct_symbols,
    "newest_n": newest_n,
    "symbol_slice": symbol_slice,
    "sample_10": sample_10,
    "key_profile": key_profile,
    "dashboard_latest": dashboard_latest,
    "dashboard_trends": dashboard_trends,
    "dashboard_grid": dashboard_grid,
    "dashboard_topic_latest": dashboard_topic_latest,
    "dashboard_topic_analytics": dashboard_topic_analytics,
    "dashboard_topic_trends": dashboard_topic_trends,
    "folder_latest": folder_latest,
    "missing_folder": missing_folder,
    "compacted_table": compacted_table,
    "compacted_days": compacted_days,
    "listed_tables": listed_tables,
    "cleared_table": cleared_table,
    "capped_events_half": capped_events_half,
    "capped_events_small": capped_events_small,
    "inspection_row_count": inspection_row_count,
    "inspection_time_range": inspection_time_range,
    "inspection_rows_by_symbol": inspection_rows_by_symbol,
    "inspection_recent_sample": inspection_recent_sample,
}

# ---------------------------------------------------------------------------------------------------
# DuckDB oracles. Views: the shared tables by name.

_USER = "CASE WHEN event_id % 5 = 0 THEN -user_id ELSE user_id END"
_TICKS = (f"SELECT event_id, {_USER} AS user_id, event_type AS symbol, value AS price, ts AS timestamp "
          "FROM events")
_DIM = "SELECT c_custkey AS user_id, c_name AS coin_name, c_mktsegment AS category FROM customer"
_ENRICHED = (f"SELECT t.user_id, d.coin_name, d.category, t.event_id, t.symbol, t.price, t.timestamp "
             f"FROM ({_TICKS}) t LEFT JOIN ({_DIM}) d ON t.user_id = d.user_id")


def _stats_sql(interval: str, keys: str, src: str, where: str = "") -> str:
    return (f"SELECT time_bucket(INTERVAL '{interval}', timestamp) AS window_start, "
            f"time_bucket(INTERVAL '{interval}', timestamp) + INTERVAL '{interval}' AS window_end, "
            f"{keys}, round(avg(price), {ROUND}) AS average_price, max(price) AS max_price, "
            f"min(price) AS min_price, count(price) AS event_count "
            f"FROM ({src}) s {where} GROUP BY ALL")


def _iso(ts: str) -> str:
    """An instant's text with no, three or six fraction digits, as needed."""
    return (f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%SZ') "
            f"WHEN epoch_us({ts}) % 1000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S.%gZ') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%fZ') END")


_ISO = _iso("ts")

_TREND_POINTS = ("SELECT symbol, time_bucket(INTERVAL '40 seconds', timestamp) AS time_bucket, "
                 "arg_max(price, {'t': timestamp, 'i': event_id}) AS price "
                 f"FROM ({_TICKS}) s GROUP BY ALL")

_GRID = (f"WITH pts AS ({_TREND_POINTS}), "
         "fr AS (SELECT symbol, max(time_bucket) AS lb FROM pts GROUP BY symbol), "
         "g AS (SELECT symbol, unnest(generate_series(time_bucket(INTERVAL '40 seconds', "
         "lb - INTERVAL 10 MINUTES), lb + INTERVAL 60 SECONDS, INTERVAL 40 SECONDS)) AS time_bucket "
         "FROM fr) "
         "SELECT g.symbol, g.time_bucket, pts.price, strftime(g.time_bucket, '%H:%M:%S') AS time_label "
         "FROM g LEFT JOIN pts ON g.symbol = pts.symbol AND g.time_bucket = pts.time_bucket")

_LOOSE = ("SELECT event_id, CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS symbol, "
          "CASE WHEN event_id % 7 = 3 THEN 'n/a' WHEN event_id % 13 = 5 THEN 'NaN' "
          "ELSE value::VARCHAR END AS price_text, "
          "CASE WHEN event_id % 11 = 4 THEN 'not-a-time' "
          "WHEN event_id % 3 = 1 THEN strftime(ts + INTERVAL 2 HOURS, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00' "
          f"ELSE {_ISO} END AS ts_text FROM events")

_NUMERIC = "('DOUBLE', 'BIGINT', 'UBIGINT')"


def _parsed_json_sql(messages: str) -> str:
    """DuckDB's own reading of tick JSON text: a field counts only when present with the right type."""
    return ("SELECT event_id, json_extract_string(j, '$.symbol') AS symbol, "
            f"CASE WHEN json_type(j, '$.price') IN {_NUMERIC} THEN json_extract(j, '$.price')::DOUBLE END "
            "AS price, timezone('UTC', TRY_CAST(json_extract_string(j, '$.timestamp') AS TIMESTAMPTZ)) "
            "AS timestamp FROM (SELECT event_id, CASE WHEN json_valid(json) THEN json::JSON END AS j "
            f"FROM ({messages}) m) p")


def _kept_ticks_sql(messages: str) -> str:
    return (f"SELECT * FROM ({_parsed_json_sql(messages)}) x WHERE symbol IS NOT NULL "
            "AND price IS NOT NULL AND NOT isnan(price) AND timestamp IS NOT NULL")


def _q(expr: str) -> str:
    return "'\"' || " + expr + " || '\"'"


_DAMAGED = (
    "SELECT event_id, CASE "
    "WHEN event_id % 19 = 0 THEN 'not json at all' "
    "WHEN event_id % 17 = 1 THEN json_object('symbol', event_type, 'price', value::VARCHAR, "
    f"'timestamp', {_ISO})::VARCHAR "
    "WHEN event_id % 13 = 2 THEN json_object('SYMBOL', event_type, 'price', value, "
    f"'timestamp', {_ISO})::VARCHAR "
    "WHEN event_id % 11 = 3 THEN '{\"symbol\":' || " + _q("event_type")
    + " || ',\"price\":' || value::VARCHAR || ',\"timestamp\":\"yesterday\"}' "
    "WHEN event_id % 7 = 4 THEN '{\"symbol\":' || " + _q("event_type")
    + " || ',\"price\":\"NaN\",\"timestamp\":' || " + _q(_ISO) + " || '}' "
    "ELSE json_object('symbol', event_type, 'price', value, 'timestamp', " + _ISO + ")::VARCHAR "
    "END AS json FROM events")

# Every damaged message with the reason for its rejection, null for a tick.
REJECTS_SQL = ("SELECT d.event_id, CASE WHEN NOT json_valid(d.json) THEN 'not_json' WHEN p.symbol IS NULL THEN 'no_symbol' "
               "WHEN p.price IS NULL OR isnan(p.price) THEN 'no_price' WHEN p.timestamp IS NULL THEN 'no_timestamp' "
               f"END AS reject_reason FROM ({_DAMAGED}) d JOIN ({_parsed_json_sql(_DAMAGED)}) p USING (event_id)")

_ASSET_LIST = "[" + ", ".join(f"{{'asset_id': '{a}', 'symbol': '{s}'}}" for a, s in SNAPSHOT_ASSETS) + "]"

# The fixture's rule per event: status, fetch time and the text of the last quote of its own asset, if usable.
_SNAPSHOTS = (
    "SELECT event_id AS snapshot_id, event_type, CASE WHEN event_id % 17 = 0 THEN 503 ELSE 200 END AS status, "
    "CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) ELSE ts END AS fetched_at, "
    "CASE WHEN event_id % 5 IN (2, 3) THEN NULL WHEN event_id % 23 = 5 THEN '1E+25' "
    "WHEN event_id % 4 = 1 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.450000000000000000001' "
    "ELSE value::VARCHAR END AS price_text FROM events")
_SNAPSHOT_QUOTES = (
    "SELECT snapshot_id, status, fetched_at, a.symbol AS symbol, "
    "CASE WHEN a.asset_id = event_type AND status BETWEEN 200 AND 299 THEN price_text END AS price_text, "
    "CAST(CASE WHEN a.asset_id = event_type AND status BETWEEN 200 AND 299 THEN price_text END AS DOUBLE) AS price "
    f"FROM (SELECT *, unnest({_ASSET_LIST}) AS a FROM ({_SNAPSHOTS}) s) c")

ORACLE_SQL: dict[str, str] = {
    "window_stats_from_messages": _stats_sql(
        "2 seconds", "symbol, coin_name, category", _ENRICHED),
    "window_stats_2s": _stats_sql("2 seconds", "symbol", _TICKS),
    "window_stats_1h": _stats_sql("1 hour", "symbol", _TICKS),
    "stats_keep_unmatched": _stats_sql("1 hour", "user_id, coin_name, category", _ENRICHED),
    "stats_drop_unmatched": _stats_sql("1 hour", "user_id, coin_name, category", _ENRICHED,
                                       "WHERE user_id IS NOT NULL AND coin_name IS NOT NULL "
                                       "AND category IS NOT NULL"),
    "dashboard_analytics_2s": (
        "SELECT time_bucket(INTERVAL '2 seconds', timestamp) AS time_bucket, symbol, coin_name, category, "
        f"round(avg(price), {ROUND}) AS average_price, max(price) AS max_price, min(price) AS min_price, "
        f"count(price) AS event_count FROM ({_ENRICHED}) s WHERE symbol IS NOT NULL "
        "AND coin_name IS NOT NULL AND category IS NOT NULL GROUP BY ALL"),
    "latest_per_symbol": (
        f"SELECT symbol, user_id, coin_name, category, event_id, price, timestamp FROM ({_ENRICHED}) s "
        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, event_id DESC) = 1"),
    "latest_per_symbol_ties": ("SELECT event_type AS symbol, CAST(1 AS BIGINT) AS rows, date_trunc('day', max(ts)) AS timestamp "
                               "FROM events GROUP BY event_type"),
    "last_price_40s": _TREND_POINTS,
    "latest_bucket_per_symbol": (f"SELECT symbol, max(time_bucket) AS latest_bucket "
                                 f"FROM ({_TREND_POINTS}) p GROUP BY symbol"),
    "dense_trend_grid": _GRID,
    "trend_points_non_null": f"SELECT * FROM ({_GRID}) x WHERE price IS NOT NULL",
    "enrich_left": _ENRICHED,
    "json_round_trip": _kept_ticks_sql(
        "SELECT event_id, json_object('symbol', event_type, 'price', value, "
        f"'timestamp', {_ISO})::VARCHAR AS json FROM events"),
    "parse_damaged": _kept_ticks_sql(_DAMAGED),
    "parse_rejects": f"SELECT * FROM ({REJECTS_SQL}) r WHERE reject_reason IS NOT NULL",
    "parse_outcomes": ("SELECT count(*) AS messages, count(*) - count(reject_reason) AS ticks, "
                       f"count(reject_reason) AS rejects FROM ({REJECTS_SQL}) r"),
    "kafka_payload": (
        "SELECT event_id, event_type AS key, json_object('symbol', event_type, 'price', value, "
        f"'timestamp', {_ISO})::VARCHAR AS value FROM events"),
    "lenient_normalise": (
        "SELECT event_id, symbol, price, timestamp, '' AS coin_name, '' AS category FROM ("
        "SELECT event_id, symbol, TRY_CAST(price_text AS DOUBLE) AS price, "
        "timezone('UTC', TRY_CAST(ts_text AS TIMESTAMPTZ)) AS timestamp "
        f"FROM ({_LOOSE}) l) x "
        "WHERE symbol IS NOT NULL AND price IS NOT NULL AND NOT isnan(price) AND timestamp IS NOT NULL"),
    "snapshot_ticks": (
        "SELECT snapshot_id, symbol, price, fetched_at AS timestamp "
        f"FROM ({_SNAPSHOT_QUOTES}) q WHERE price IS NOT NULL"),
    "snapshot_payload": (
        "SELECT snapshot_id, symbol AS key, '{\"symbol\":\"' || symbol || '\",\"price\":' || price_text || "
        f"',\"timestamp\":\"' || {_iso('fetched_at')} || '\"}}' AS value "
        f"FROM ({_SNAPSHOT_QUOTES}) q WHERE price IS NOT NULL"),
    "fetch_time_stamped": f"SELECT count(*) AS stamped_ticks FROM ({_SNAPSHOT_QUOTES}) q WHERE price IS NOT NULL",
    "enrich_missing_metadata": ("SELECT symbol, CAST(NULL AS VARCHAR) AS coin_name, CAST(NULL AS VARCHAR) AS category, "
                                f"event_id, user_id, price, timestamp FROM ({_TICKS}) t"),
    "enrich_replaces_columns": _ENRICHED,
    "bytes_to_ticks": f"SELECT symbol, price, timestamp FROM ({_TICKS}) t",
    "sample_10": "SELECT least(10, count(*)) AS sample_rows FROM events",
    "snapshot_rejects": (
        "SELECT snapshot_id, status, CASE WHEN status NOT BETWEEN 200 AND 299 THEN 'http_status' "
        "ELSE 'no_prices' END AS reason "
        f"FROM ({_SNAPSHOT_QUOTES}) q GROUP BY snapshot_id, status "
        "HAVING count(price) = 0"),
    "rows_by_symbol": (f"SELECT symbol, count(*) AS count FROM ({_ENRICHED}) s GROUP BY symbol "
                       "ORDER BY count DESC, symbol"),
    "rows_by_symbol_name_category": (
        f"SELECT symbol, coin_name, category, count(*) AS count FROM ({_ENRICHED}) s GROUP BY ALL "
        "ORDER BY count DESC, symbol, coin_name, category"),
    "time_range": ("SELECT min(ts) AS first_event_timestamp, max(ts) AS latest_event_timestamp "
                   "FROM events"),
    "row_count": "SELECT count(*) AS record_count FROM events",
    "distinct_symbols": ("SELECT DISTINCT event_type AS symbol FROM events WHERE event_type IS NOT NULL "
                         "ORDER BY symbol"),
    "newest_n": (f"SELECT * FROM ({_ENRICHED}) s ORDER BY timestamp DESC, event_id DESC LIMIT 20"),
    "symbol_slice": f"SELECT * FROM ({_ENRICHED}) s WHERE symbol = 'purchase'",
    "key_profile": (f"SELECT symbol, coin_name, category, count(*) AS count, "
                    "min(timestamp) AS first_event_timestamp, max(timestamp) AS latest_event_timestamp "
                    f"FROM ({_ENRICHED}) s GROUP BY ALL"),
}
ORACLE_SQL.update({
    "inspection_row_count": "SELECT count(*) AS record_count FROM events",
    "inspection_time_range": ORACLE_SQL["time_range"],
    "inspection_rows_by_symbol": ORACLE_SQL["rows_by_symbol_name_category"],
    # Event times are unique in the shared table, so the newest 20 rows are well defined.
    "inspection_recent_sample": (f"SELECT symbol, coin_name, category, price, timestamp FROM ({_ENRICHED}) s "
                                 "ORDER BY timestamp DESC LIMIT 20"),
})

# Dashboard over the loose feed: the lenient oracle's rows, then the dashboard's queries.
_LENIENT = ORACLE_SQL["lenient_normalise"]
_LOOSE_POINTS = ("SELECT symbol, time_bucket(INTERVAL '40 seconds', timestamp) AS time_bucket, "
                 f"arg_max(price, {{'t': timestamp, 'i': event_id}}) AS price FROM ({_LENIENT}) n GROUP BY ALL")
ORACLE_SQL.update({
    "dashboard_latest": (f"SELECT symbol, coin_name, category, price, timestamp FROM ({_LENIENT}) n "
                         "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, event_id DESC) = 1"),
    "dashboard_trends": _LOOSE_POINTS,
    "dashboard_grid": _GRID.replace(_TREND_POINTS, _LOOSE_POINTS),
})

# The same over damaged messages, read leniently: a price in quotes counts.
_TOPIC = ("SELECT * FROM (SELECT event_id, json_extract_string(j, '$.symbol') AS symbol, "
          "TRY_CAST(json_extract_string(j, '$.price') AS DOUBLE) AS price, '' AS coin_name, '' AS category, "
          "timezone('UTC', TRY_CAST(json_extract_string(j, '$.timestamp') AS TIMESTAMPTZ)) AS timestamp "
          f"FROM (SELECT event_id, CASE WHEN json_valid(json) THEN json::JSON END AS j FROM ({_DAMAGED}) m) p) x "
          "WHERE symbol IS NOT NULL AND price IS NOT NULL AND NOT isnan(price) AND timestamp IS NOT NULL")
_STORED_LATEST = (f"SELECT symbol, coin_name, category, price, timestamp FROM ({_ENRICHED}) s "
                  "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) = 1")
ORACLE_SQL.update({
    "dashboard_topic_latest": (
        f"SELECT symbol, coin_name, category, price, timestamp FROM ({_TOPIC}) n "
        "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, event_id DESC) = 1"),
    "dashboard_topic_analytics": (
        "SELECT time_bucket(INTERVAL '10 seconds', timestamp) AS time_bucket, symbol, coin_name, category, "
        f"round(avg(price), {ROUND}) AS average_price, max(price) AS max_price, min(price) AS min_price, "
        f"count(price) AS event_count FROM ({_TOPIC}) n GROUP BY ALL"),
    "dashboard_topic_trends": (
        "SELECT symbol, time_bucket(INTERVAL '60 seconds', timestamp) AS time_bucket, "
        f"arg_max(price, {{'t': timestamp, 'i': event_id}}) AS price FROM ({_TOPIC}) n GROUP BY ALL"),
    # Event times are unique in the shared table.
    "folder_latest": _STORED_LATEST,
    "missing_folder": "SELECT count(*) AS stored_rows, CAST(0 AS BIGINT) AS missing_rows FROM events "
                      "WHERE value IS NOT NULL AND NOT isnan(value) AND event_type IS NOT NULL AND ts IS NOT NULL",
    "listed_tables": "SELECT CAST(1 AS BIGINT) AS databases, CAST(1 AS BIGINT) AS listed, count(*) AS record_count "
                     "FROM events",
    "cleared_table": "SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM events",
    "compacted_table": _ENRICHED,
    "compacted_days": f"SELECT *, CAST(timestamp AS DATE) AS day FROM ({_ENRICHED}) e",
    "capped_events_half": (f"SELECT * FROM ({_TICKS}) t QUALIFY row_number() OVER (ORDER BY timestamp, symbol) "
                           "<= (SELECT count(*) // 2 FROM events)"),
    "capped_events_small": (f"SELECT * FROM ({_TICKS}) t "
                            "QUALIFY row_number() OVER (ORDER BY timestamp, symbol) <= 100"),
})

_HOT_TICKS = (f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE {_USER} END AS user_id, "
              "event_type AS symbol, value AS price, ts AS timestamp FROM events")
ORACLE_SQL["hot_key_enrich_stats"] = _stats_sql(
    "1 hour", "user_id, coin_name, category",
    f"SELECT t.user_id, d.coin_name, d.category, t.price, t.timestamp FROM ({_HOT_TICKS}) t "
    f"LEFT JOIN ({_DIM}) d ON t.user_id = d.user_id")
