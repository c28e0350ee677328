"""Structured Streaming: watermark lateness, update mode across restarts, storage sinks."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tickwise.functions.parse import parse_ticks
from tickwise.operators.enrich import enrich
from tickwise.plans import catalog
from tickwise.sources.files import read_metadata, read_table, replay_stream
from tickwise.streaming import queries as sq
from tickwise.streaming.sinks import latest_updates, versioned_writer

from fixtures import METADATA_CSV, write

BASE = dt.datetime(2026, 5, 7, 21, 5, 0)


def _msg(symbol, price, t):
    return json.dumps({"symbol": symbol, "price": price,
                       "timestamp": t.strftime("%Y-%m-%dT%H:%M:%S.%fZ")})


def _at(**kw):
    return BASE + dt.timedelta(**kw)


# One file per availableNow run. Each run ends with a no-data micro-batch that moves the watermark to
# (newest event time - 2 s), so a tick is dropped exactly when its window ends at or before the
# watermark left by the previous run.
BATCHES = [
    # Newest 21:05:20 -> watermark 21:05:18.
    [("BTC", 100.0, _at()), ("BTC", 120.0, _at(seconds=10)), ("ETH", 50.0, _at(seconds=20)),
     ("ZZZ", 1.0, _at(seconds=20))],
    # 21:05:19 is older than the newest tick but its window [21:05:18, 21:05:20) ends after the
    # watermark: accepted. 21:05:00.5 falls in a window that ended at 21:05:02: dropped.
    [("BTC", 140.0, _at(seconds=19)), ("BTC", 110.0, _at(seconds=0, microseconds=500000))],
    # 21:05:19.5: its window still ends after the watermark 21:05:18, so it is accepted and merges into
    # the open window. Newest moves to 21:10:00 -> watermark 21:09:58.
    [("BTC", 160.0, _at(seconds=19, microseconds=500000)), ("ETH", 55.0, _at(minutes=5))],
    # Watermark is now 21:09:58: the 21:05:19 window is closed, this tick is dropped.
    [("BTC", 170.0, _at(seconds=19, microseconds=900000))],
]


def _run(spark, workdir, batches):
    meta = read_metadata(spark, write(os.path.join(workdir, "meta.csv"), METADATA_CSV))
    stage, out, ckpt, raw = (os.path.join(workdir, d) for d in ("stage", "out", "ckpt", "raw"))
    os.makedirs(stage)
    stream = replay_stream(spark, stage, "text").withColumnRenamed("value", "json")
    enriched = enrich(parse_ticks(stream), meta, broadcast=True)
    dropped = []
    for i, rows in enumerate(batches):
        write(os.path.join(stage, f"batch-{i}.json"), "\n".join(_msg(*r) for r in rows) + "\n")
        q = sq.window_stats_query(enriched, ckpt, versioned_writer(out), "2 seconds", "2 seconds",
                                  trigger={"availableNow": True})
        sq.drain(q)
        dropped.append(sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                           for p in q.recentProgress if p.get("stateOperators")))
        sq.drain(sq.raw_storage_query(enriched, raw, ckpt + "-raw", trigger={"availableNow": True}))
    keys = ["window_start", "window_end", "symbol", "coin_name", "category"]
    return latest_updates(spark, out, keys), spark.read.parquet(raw), dropped, out


def test_lateness_rules_update_mode(spark, workdir):
    final, raw, dropped, out = _run(spark, workdir, BATCHES)
    stats = {(r["window_start"], r["symbol"]): (r["event_count"], r["average_price"], r["coin_name"])
             for r in final.collect()}
    assert stats[(_at(), "BTC")] == (1, 100.0, "Bitcoin")
    assert stats[(_at(seconds=18), "BTC")] == (2, 150.0, "Bitcoin")
    # Unmatched symbol forms its own group with null metadata.
    assert stats[(_at(seconds=20), "ZZZ")] == (1, 1.0, None)
    assert stats[(_at(minutes=5), "ETH")] == (1, 55.0, "Ethereum")
    assert len(stats) == 6
    assert dropped == [0, 1, 0, 1]
    # Update mode: a micro-batch emits only the groups it changed.
    emitted = {r["batch_id"]: r["count"] for r in
               spark.read.parquet(out).groupBy("batch_id").count().collect()}
    assert emitted[0] == 4 and sum(emitted.values()) == 4 + 1 + 2
    # Raw storage has no watermark: every tick is stored, the dropped ones included.
    assert raw.count() == 9 and raw.filter(F.col("price").isin(110.0, 170.0)).count() == 2


def test_file_sink_is_exactly_once_on_restart(spark, workdir):
    """Restarting a finished query from its checkpoint writes nothing again."""
    _, raw, _, _ = _run(spark, workdir, BATCHES[:1])
    assert raw.count() == 4
    meta = read_metadata(spark, write(os.path.join(workdir, "meta.csv"), METADATA_CSV))
    stream = replay_stream(spark, os.path.join(workdir, "stage"), "text").withColumnRenamed("value", "json")
    again = sq.raw_storage_query(enrich(parse_ticks(stream), meta), os.path.join(workdir, "raw"),
                                 os.path.join(workdir, "ckpt-raw"), trigger={"availableNow": True})
    sq.drain(again)
    assert spark.read.parquet(os.path.join(workdir, "raw")).count() == 4


def test_flat_folder_contract(spark, workdir):
    """foreachBatch append storage leaves only Parquet files directly in the folder."""
    stage, table = os.path.join(workdir, "stage"), os.path.join(workdir, "table")
    os.makedirs(stage)
    write(os.path.join(stage, "a.json"), "\n".join(_msg(*r) for r in BATCHES[0]) + "\n")
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    q = sq.raw_storage_query(stream, table, os.path.join(workdir, "ckpt"), exactly_once=False,
                             trigger={"availableNow": True})
    sq.drain(q)
    entries = os.listdir(table)
    assert entries and all(e.endswith(".parquet") and not e.startswith(".") for e in entries)
    assert not any(os.path.isdir(os.path.join(table, e)) for e in entries)
    assert "_SUCCESS" not in entries
    assert spark.read.parquet(table).count() == 4


def test_empty_batches_write_nothing(spark, workdir):
    stage, table = os.path.join(workdir, "stage"), os.path.join(workdir, "table")
    os.makedirs(stage)
    write(os.path.join(stage, "a.json"), "garbage\n{}\n")
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    sq.drain(sq.raw_storage_query(stream, table, os.path.join(workdir, "ckpt"), exactly_once=False,
                                  trigger={"availableNow": True}))
    assert not os.path.exists(table) or not [e for e in os.listdir(table) if e.endswith(".parquet")]


def test_memory_sink_and_named_queries(spark, workdir):
    stage = os.path.join(workdir, "stage")
    os.makedirs(stage)
    write(os.path.join(stage, "a.json"), "\n".join(_msg(*r) for r in BATCHES[0]) + "\n")
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    stream = stream.withColumn("coin_name", F.lit("n")).withColumn("category", F.lit("c"))
    q = sq.window_stats_query(stream, os.path.join(workdir, "ckpt"), "memory", name="tick_stats_mem",
                              trigger={"availableNow": True})
    sq.drain(q)
    assert q.name == "tick_stats_mem"
    assert spark.table("tick_stats_mem").count() == 4


def test_dimension_edits_show_in_next_micro_batch(spark, workdir):
    """The static side of a stream-static join is read again for every micro-batch."""
    meta_path = write(os.path.join(workdir, "meta.csv"), METADATA_CSV)
    stage, raw = os.path.join(workdir, "stage"), os.path.join(workdir, "raw")
    os.makedirs(stage)
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    enriched = enrich(stream, read_metadata(spark, meta_path), broadcast=True)
    q = sq.raw_storage_query(enriched, raw, os.path.join(workdir, "ck"))  # one running query
    try:
        write(os.path.join(stage, "a.json"), _msg("BTC", 1.0, _at()) + "\n")
        q.processAllAvailable()
        write(meta_path, METADATA_CSV.replace("BTC,Bitcoin,", "BTC,Bitcoin (renamed),"))
        write(os.path.join(stage, "b.json"), _msg("BTC", 2.0, _at(seconds=5)) + "\n")
        q.processAllAvailable()
    finally:
        q.stop()
    names = {r["price"]: r["coin_name"] for r in spark.read.parquet(raw).collect()}
    assert names == {1.0: "Bitcoin", 2.0: "Bitcoin (renamed)"}


def test_day_partitioned_storage_prunes_partitions(spark, workdir):
    stage, table = os.path.join(workdir, "stage"), os.path.join(workdir, "table")
    os.makedirs(stage)
    days = [_at(), _at(days=1), _at(days=2, seconds=3)]
    write(os.path.join(stage, "a.json"), "\n".join(_msg("BTC", float(i), t) for i, t in enumerate(days)) + "\n")
    meta = read_metadata(spark, write(os.path.join(workdir, "meta.csv"), METADATA_CSV))
    enriched = enrich(parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json")), meta)
    for exactly_once in (False, True):
        out = f"{table}-{exactly_once}"
        sq.drain(sq.raw_storage_query(enriched, out, f"{out}-ck", exactly_once=exactly_once,
                                      trigger={"availableNow": True}, partition_by_day=True))
        assert sorted(d for d in os.listdir(out) if d.startswith("day=")) == [
            "day=2026-05-07", "day=2026-05-08", "day=2026-05-09"]
        name = catalog.register_table(spark, "tw_parts", f"t_{exactly_once}".lower(), out,
                                      partition_by_day=True)
        one_day = read_table(spark, name).filter("day = DATE'2026-05-08'")
        assert [r["price"] for r in one_day.collect()] == [1.0]
        plan = one_day._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in plan


def test_console_sink_runs(spark, workdir):
    stage = os.path.join(workdir, "stage")
    os.makedirs(stage)
    write(os.path.join(stage, "a.json"), "\n".join(_msg(*r) for r in BATCHES[0]) + "\n")
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    stream = stream.withColumn("coin_name", F.lit("n")).withColumn("category", F.lit("c"))
    q = sq.window_stats_query(stream, os.path.join(workdir, "ckpt"), "console", trigger={"availableNow": True})
    progress = sq.drain(q)
    assert q.exception() is None and progress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming")


def test_clear_file_sink_folder_with_its_checkpoint(spark, workdir):
    stage, out, ck = (os.path.join(workdir, d) for d in ("stage", "out", "ck"))
    os.makedirs(stage)
    write(os.path.join(stage, "a.json"), "\n".join(_msg(*r) for r in BATCHES[0]) + "\n")
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    sq.drain(sq.raw_storage_query(stream, out, ck, trigger={"availableNow": True}))
    assert spark.read.parquet(out).count() == 4
    catalog.clear_location(spark, out, checkpoint=ck)
    assert os.listdir(out) == [] and not os.path.exists(ck)
    # A restarted query begins a new log and reads the source from the start again.
    sq.drain(sq.raw_storage_query(stream, out, ck, trigger={"availableNow": True}))
    assert spark.read.parquet(out).count() == 4


def test_streaming_stats_combine_before_the_state_store(spark, workdir, capsys):
    stage = os.path.join(workdir, "stage")
    os.makedirs(stage)
    # One symbol carries most ticks.
    rows = [("BTC", float(i), _at(seconds=i % 7)) for i in range(60)] + [("ETH", 1.0, _at())]
    write(os.path.join(stage, "a.json"), "\n".join(_msg(*r) for r in rows) + "\n")
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    stream = stream.withColumn("coin_name", F.lit("n")).withColumn("category", F.lit("c"))
    q = sq.window_stats_query(stream, os.path.join(workdir, "ckpt"), "memory", name="tick_stats_plan",
                              trigger={"availableNow": True})
    sq.drain(q)
    capsys.readouterr()
    q.explain()  # the physical plan of the last micro-batch
    plan = capsys.readouterr().out
    assert "partial_avg" in plan and "StateStoreSave" in plan
    assert plan.index("StateStoreSave") < plan.index("partial_avg")  # partial aggregate sits below the state
    assert spark.table("tick_stats_plan").agg(F.sum("event_count")).first()[0] == 61
