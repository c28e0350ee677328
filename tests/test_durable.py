"""Commit log, versioned dimension, rejects, late rows, open windows, rollups, tiers, caps and hot keys."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickwise.functions.parse import accepted, counted, parse_ticks, rejected, split_messages
from tickwise.functions.snapshot import snapshot_split
from tickwise.operators.joins import salted_join
from tickwise.operators.latest import latest_per_key
from tickwise.sources.files import pin_metadata, replay_stream
from tickwise.streaming import flat_log as fl
from tickwise.streaming import queries as sq
from tickwise.streaming import tiers
from tickwise.streaming.cap import EventCap
from tickwise.streaming.dimension import VersionedDimension
from tickwise.streaming.flat_log import FlatLog
from tickwise.streaming.heavy import HeavyHitters
from tickwise.streaming.late import LateLedger
from tickwise.streaming.rollup import RollupTable
from tickwise.streaming.sinks import latest_updates, versioned_writer
from tickwise.streaming.state import open_windows
from tickwise.streaming.tiers import TieredLog

from fixtures import METADATA_CSV, write

TICKS = "symbol string, price double, timestamp timestamp"
BASE = dt.datetime(2026, 5, 7, 21, 5, 0)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def ticks(spark, rows):
    return spark.createDataFrame(rows, TICKS)


def batch_of(spark, k, n=40):
    return ticks(spark, [("AB"[i % 2], float(100 * k + i), at(60 * k + i)) for i in range(n)]).repartition(4)


class Stop(Exception):
    pass


# -- flat log ----------------------------------------------------------------------------------------------

def log_at(workdir, **kw):
    return FlatLog(os.path.join(workdir, "table"), os.path.join(workdir, "log"), **kw)


def stored(spark, log):
    return sorted(r["price"] for r in spark.read.parquet(log.table).collect())


def whole(log, spark, batches):
    """Every row of the batches once, in the folder and through the log, and nothing else in the folder."""
    expected = sorted(float(100 * k + i) for k in batches for i in range(40))
    assert stored(spark, log) == expected
    assert sorted(r["price"] for r in log.read(spark, spark.read.parquet(log.table).schema).collect()) == expected
    assert sorted(os.listdir(log.table)) == sorted(log.files(spark))
    assert all(n.endswith(".parquet") and not n.startswith(".") for n in os.listdir(log.table))


def test_batch_that_fails_before_its_commit_is_stored_once(spark, workdir):
    log = log_at(workdir)

    def stop(batch_id):
        raise Stop

    for k in range(3):
        with pytest.raises(Stop):
            log.write(batch_of(spark, k), k, before_commit=stop)
        assert log.write(batch_of(spark, k), k) is False  # published already: not computed again
        assert log.write(batch_of(spark, k), k) is False  # committed
    whole(log, spark, range(3))


def test_batch_that_fails_among_its_files_is_completed(spark, workdir, monkeypatch):
    log, moved = log_at(workdir), []

    def some(*a):
        if len(moved) == 2:
            raise Stop
        moved.append(a)
        return real(*a)

    real = fl.move
    monkeypatch.setattr(fl, "move", some)
    with pytest.raises(Stop):
        log.write(batch_of(spark, 0), 0)
    assert len(os.listdir(log.table)) == 2 and log.files(spark) == []
    before = {n: os.stat(os.path.join(log.table, n)).st_mtime_ns for n in os.listdir(log.table)}
    monkeypatch.setattr(fl, "move", real)
    log.write(batch_of(spark, 0), 0)
    whole(log, spark, [0])
    # What a stream over the folder may have read already is never replaced.
    assert all(os.stat(os.path.join(log.table, n)).st_mtime_ns == t for n, t in before.items())


def test_batch_that_fails_while_staged_starts_anew(spark, workdir, monkeypatch):
    log = log_at(workdir)
    monkeypatch.setattr(FlatLog, "_write_zones", lambda *a: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        log.write(batch_of(spark, 0), 0)
    monkeypatch.undo()
    assert log.write(batch_of(spark, 0), 0) is True
    whole(log, spark, [0])


def test_log_stays_short_and_zones_agree(spark, workdir):
    log = log_at(workdir, compact_every=3)
    for k in range(8):
        log.write(batch_of(spark, k), k)
        assert log.write(batch_of(spark, k), k) is False
    whole(log, spark, range(8))
    assert len(os.listdir(os.path.join(log.path, "committed"))) <= 4
    assert len(os.listdir(os.path.join(log.path, "zones"))) <= 4
    table = spark.read.parquet(log.table)
    assert log.totals(spark).collect() == table.agg(F.count(F.lit(1)), F.min("timestamp"), F.max("timestamp")).collect()
    assert sorted(map(tuple, log.rows_by_key(spark).collect())) == [("A", 160), ("B", 160)]


def test_newest_opens_only_files_that_can_hold_them(spark, workdir):
    log = log_at(workdir)
    for k in range(6):
        log.write(batch_of(spark, k), k)
    schema = spark.read.parquet(log.table).schema
    newest = log.newest(spark, schema, 5)
    assert [r["price"] for r in newest.collect()] == [539.0, 538.0, 537.0, 536.0, 535.0]
    assert 0 < len(newest.inputFiles()) <= 4 < len(log.files(spark))
    assert log.newest(spark, schema, 1000).count() == 240


def test_empty_batches_and_tables(spark, workdir):
    log = log_at(workdir)
    assert log.totals(spark).first()["record_count"] == 0 and log.files(spark) == []
    log.write(batch_of(spark, 0).where("price < 0"), 0)
    assert log.files(spark) == [] and log.is_committed(spark, 0)
    assert log.newest(spark, batch_of(spark, 0).schema, 3).collect() == []


def test_a_new_log_never_meets_older_files(spark, workdir):
    log_at(workdir).write(batch_of(spark, 0), 0)
    FlatLog(os.path.join(workdir, "table"), os.path.join(workdir, "log2")).write(batch_of(spark, 1), 0)
    assert len(stored(spark, log_at(workdir))) == 80


def test_day_folders(spark, workdir):
    log = log_at(workdir)
    rows = ticks(spark, [("A", float(i), at(86_400 * (i % 3))) for i in range(30)]).coalesce(1)
    log.write(rows.withColumn("day", F.to_date("timestamp")), 0, partition_by=("day",))
    assert sorted(os.listdir(log.table)) == ["day=2026-05-07", "day=2026-05-08", "day=2026-05-09"]
    assert len(stored(spark, log)) == 30 and len(log.files(spark)) == 3
    assert sorted(r["rows"] for r in log.zones(spark).collect()) == [10, 10, 10]


# -- dimension ---------------------------------------------------------------------------------------------

def names(version):
    return {r["symbol"]: r["coin_name"] for r in version[0].collect()}


def test_each_batch_keeps_its_version(spark, workdir):
    path = write(os.path.join(workdir, "m.csv"), METADATA_CSV)
    dim = VersionedDimension(path, os.path.join(workdir, "versions"))
    assert names(dim.resolve(spark, 0))["BTC"] == "Bitcoin"
    write(path, METADATA_CSV.replace("BTC,Bitcoin", "BTC,Renamed"))
    assert names(dim.resolve(spark, 0))["BTC"] == "Bitcoin"  # a replay
    assert names(dim.resolve(spark, 1))["BTC"] == "Renamed"
    write(path, METADATA_CSV + "BTC,Again,Twice\n")
    assert names(dim.resolve(spark, 2))["BTC"] == "Renamed"
    os.remove(path)
    assert names(dim.resolve(spark, 3))["BTC"] == "Renamed"
    assert [b for b, _ in dim.refused] == [2, 3] and "not unique" in dim.refused[0][1] and "gone" in dim.refused[1][1]
    write(path, METADATA_CSV.replace("DOGE,Dogecoin,Meme Coin\n", ""))
    assert "DOGE" not in names(dim.resolve(spark, 4))
    again = VersionedDimension(path, os.path.join(workdir, "versions"))  # another process
    assert names(again.resolve(spark, 0))["BTC"] == "Bitcoin" and names(again.resolve(spark, 3))["BTC"] == "Renamed"
    assert [b for b, _ in again.history(spark)] == [0, 1, 4]
    assert len([n for n in os.listdir(os.path.join(workdir, "versions")) if n.startswith("version=")]) == 3


def test_first_version(spark, workdir):
    missing = VersionedDimension(os.path.join(workdir, "none.csv"), os.path.join(workdir, "v1"))
    assert names(missing.resolve(spark, 0)) == {}
    twice = VersionedDimension(write(os.path.join(workdir, "m.csv"), METADATA_CSV + "BTC,X,Y\n"), os.path.join(workdir, "v2"))
    with pytest.raises(ValueError, match="not unique"):
        twice.resolve(spark, 0)
    assert not [n for n in os.listdir(workdir) if n == "v2"] or not os.listdir(os.path.join(workdir, "v2"))


def test_pinned_metadata_is_checked_before_it_is_a_version(spark, workdir):
    target = os.path.join(workdir, "pins")
    with pytest.raises(ValueError, match="not unique"):
        pin_metadata(spark, write(os.path.join(workdir, "m.csv"), METADATA_CSV + "BTC,X,Y\n"), target, 100, 10_000)
    assert not os.path.exists(target) or os.listdir(target) == []
    path = write(os.path.join(workdir, "m.csv"), METADATA_CSV)
    assert pin_metadata(spark, path, target, 100, 10_000)[0].count() == 10
    version = os.path.join(target, [n for n in os.listdir(target) if n.startswith("version=")][0])
    for name in os.listdir(version):  # as a crash in the middle of writing leaves it
        if name.startswith("part-"):
            os.remove(os.path.join(version, name))
    spark.createDataFrame([], "symbol string, coin_name string, category string").write.mode("append").parquet(version)
    with pytest.raises(ValueError, match="damaged"):
        pin_metadata(spark, path, target, 100, 10_000)


# -- rejects -----------------------------------------------------------------------------------------------

MESSAGES = [('{"symbol":"A","price":1.5,"timestamp":"2026-05-07T21:05:00Z"}', None), (None, "empty"), ("", "empty"),
            ("  ", "empty"), ("not json", "not_json"), ('["A"]', "not_json"), ('{"symbol":"A"', "not_json"),
            ("{}", "no_symbol"), ('{"SYMBOL":"A","price":1,"timestamp":"2026-05-07T21:05:00Z"}', "no_symbol"),
            ('{"symbol":"A","timestamp":"2026-05-07T21:05:00Z"}', "no_price"),
            ('{"symbol":"A","price":"NaN","timestamp":"2026-05-07T21:05:00Z"}', "no_price"),
            ('{"symbol":"A","price":null,"timestamp":"yesterday"}', "no_price"),
            ('{"symbol":"A","price":2,"timestamp":"yesterday"}', "no_timestamp")]


def test_one_parse_tells_ticks_and_rejects(spark):
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(MESSAGES)], "id int, json string")
    seen = Observation()
    split = counted(split_messages(df, keep=("id",)), seen)
    reasons = {r["id"]: r["reject_reason"] for r in split.collect()}
    for i, (message, reason) in enumerate(MESSAGES):
        assert (reasons[i] is None) == (reason is None), message
        if message != '{"symbol":"A"':  # cut off: what was read before counts as read
            assert reasons[i] == reason, message
    assert seen.get == {"messages": 13, "accepted": 1, "rejected": 12}
    assert accepted(split).drop("id").collect() == parse_ticks(df).collect()
    assert rejected(split, ("id",)).count() == 12
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


# -- late rows and open windows ----------------------------------------------------------------------------

def message(symbol, price, t):
    return json.dumps({"symbol": symbol, "price": price, "timestamp": t.strftime("%Y-%m-%dT%H:%M:%S.%fZ")})


def stats_runs(spark, workdir, batches, output_mode="update"):
    stage, ck, out = (os.path.join(workdir, d) for d in ("stage", "ck", "out"))
    os.makedirs(stage)
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    stream = stream.withColumns({"coin_name": F.lit("n"), "category": F.lit(None).cast("string")})
    for i, rows in enumerate(batches):
        write(os.path.join(stage, f"{i}.json"), "\n".join(message(*r) for r in rows) + "\n")
        query = sq.window_stats_query(stream, ck, versioned_writer(out), output_mode=output_mode, trigger={"availableNow": True})
        sq.drain(query)
        yield ck, out, query


def test_ledger_has_what_the_state_operator_dropped(spark, workdir):
    batches = [[("A", 1.0, at(0)), ("A", 2.0, at(20))], [("A", 3.0, at(19)), ("A", 4.0, at(0.5))],
               [("A", 5.0, at(19.5)), ("B", 6.0, at(300))], [("A", 7.0, at(19.9)), ("B", 8.0, at(301)), ("C", 9.0, at(1))]]
    dropped = 0
    ledger = LateLedger(os.path.join(workdir, "ck"), os.path.join(workdir, "late"),
                        lambda lines: parse_ticks(lines.withColumnRenamed("value", "json")))
    for _, _, query in stats_runs(spark, workdir, batches):
        dropped += sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
        ledger.collect(spark, query.recentProgress)
    found = ledger.read(spark, TICKS)
    assert sorted(r["price"] for r in found.collect()) == [4.0, 7.0, 9.0] and dropped == 3
    assert found.select("batch_id").distinct().count() == 2
    other = LateLedger(os.path.join(workdir, "ck"), os.path.join(workdir, "late2"), ledger.parse)
    other.collect(spark)  # without the progress every batch is read again
    assert sorted(r["price"] for r in other.read(spark, TICKS).collect()) == [4.0, 7.0, 9.0]
    assert other.collect(spark) == []


def test_open_and_emitted_windows_are_all_windows(spark, workdir):
    batches = [[("A", 1.0, at(0)), ("B", 5.0, at(1))], [("A", 2.0, at(10)), ("A", 4.0, at(10.5))], [("B", 3.0, at(12))]]
    for ck, out, _ in stats_runs(spark, workdir, batches, "append"):
        pass
    emitted = {(r["window_start"], r["symbol"]) for r in spark.read.parquet(out).collect()}
    held = {(r["window_start"], r["symbol"]): (r["average_price"], r["max_price"], r["min_price"], r["event_count"])
            for r in open_windows(spark, ck).collect()}
    assert emitted == {(at(0), "A"), (at(0), "B")}
    assert sorted(held.values()) == [(3.0, 3.0, 3.0, 1), (3.0, 4.0, 2.0, 2)]
    assert not emitted & set(held)


# -- rollups and tiers -------------------------------------------------------------------------------------

def test_rollups_merge_replays_and_late_batches(spark, workdir):
    table = RollupTable(os.path.join(workdir, "r"), segment_seconds=60)
    batches = [batch_of(spark, k) for k in (2, 0, 3, 0, 1)]
    for k, b in enumerate(batches):
        assert table.write(b, k) is True and table.write(b, k) is False
        if k == 3:  # merged, but the record got lost with the driver
            os.remove(os.path.join(workdir, "r", "records", f"{3:012d}.json"))
            assert table.write(b, k) is True
    every = batches[0]
    for b in batches[1:]:
        every = every.unionByName(b)
    for width in ("2 seconds", "40 seconds", "1 hour"):
        direct = every.groupBy(F.window("timestamp", width)["start"].alias("w"), "symbol").agg(
            F.avg("price"), F.max("price"), F.min("price"), F.count("price"))
        found = table.rollup(spark, width).drop("window_end")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, direct.collect()))
    versions = os.listdir(os.path.join(workdir, "r", "states"))
    assert len(os.listdir(os.path.join(workdir, "r", "records"))) <= 2 and len(versions) <= 5
    # An untouched segment keeps its files.
    segments = table._record(spark)["segments"]
    assert len(set(segments.values())) > 1


def test_rollup_without_rows(spark, workdir):
    table = RollupTable(os.path.join(workdir, "r"))
    table.write(ticks(spark, []), 0)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    table.write(ticks(spark, [("A", 1.0, None), ("A", 2.0, at(1)), (None, 3.0, at(1))]), 1)
    assert sorted(r["event_count"] for r in table.rollup(spark, "1 hour").collect()) == [1, 1]


def test_tiers_read_the_same_rows_before_during_and_after_a_merge(spark, workdir):
    log, plain = TieredLog(os.path.join(workdir, "t"), ["k"], fan_in=2), os.path.join(workdir, "plain")
    writer = versioned_writer(plain)

    def rows():
        return sorted(map(tuple, log.latest(spark).collect()))

    for k in range(11):
        df = spark.range(12).where(F.col("id") % (k % 4 + 1) == 0).select(F.col("id").alias("k"), F.lit(f"v{k}").alias("name"),
                                                                          F.lit(float(k)).alias("x"))
        writer(df, k)
        during = []
        log.write(df, k, before_merge=lambda: during.append(rows()))
        assert log.write(df, k) is False
        expected = sorted(map(tuple, latest_updates(spark, plain, ["k"]).collect()))
        assert rows() == expected and all(d == expected for d in during)
        assert len(log.folders(spark)) <= 4
    assert len(os.listdir(os.path.join(workdir, "t", "data"))) <= 8


def test_tiers_rewrite_no_row_twice_for_one_batch(spark, workdir, monkeypatch):
    """Batches with rows, each followed by one without: the closing batches of a stream."""
    written, newest = [], tiers.newest_of_each
    monkeypatch.setattr(tiers, "newest_of_each", lambda found, *a: written.append(found.count()) or newest(found, *a))
    log = TieredLog(os.path.join(workdir, "t"), ["k"], fan_in=2)
    rows = {}
    for k in range(8):
        new = {} if k % 2 else {i: k for i in range(k, k + 6)}
        rows |= new
        log.write(spark.createDataFrame(list(new.items()), "k int, x int"), k)
        kept = list(written)
        assert dict(map(tuple, log.latest(spark).collect())) == rows
        written[:] = kept
    # Merged at batches 3 (two folders with rows) and 7 (the merged folder and two more), once each.
    assert written == [12, 8 + 12]
    assert len(log.folders(spark)) == 1


def test_tiers_without_any_row_keep_their_schema(spark, workdir):
    log = TieredLog(os.path.join(workdir, "t"), ["k"], fan_in=2)
    for k in range(4):
        log.write(spark.createDataFrame([], "k int, x int"), k)
    assert log.latest(spark).columns == ["k", "x"] and log.latest(spark).count() == 0
    log.write(spark.createDataFrame([(1, 2)], "k int, x int"), 4)
    assert [tuple(r) for r in log.latest(spark).collect()] == [(1, 2)]


def test_tiers_go_on_from_a_list_of_three_parts(spark, workdir):
    path = os.path.join(workdir, "t")
    log = TieredLog(path, ["k"], fan_in=2)
    log.write(spark.createDataFrame([(1, 0), (2, 0)], "k int, x int"), 0)
    listed = os.path.join(path, "lists", sorted(n for n in os.listdir(os.path.join(path, "lists")) if n.endswith(".json"))[-1])
    with open(listed, "w") as f:
        json.dump({"step": 0, "folders": [[0, 0, 0]], "gone": []}, f)
    assert log.write(spark.createDataFrame([(9, 9)], "k int, x int"), 0) is False
    log.write(spark.createDataFrame([(2, 1)], "k int, x int"), 1)
    assert sorted(map(tuple, log.latest(spark).collect())) == [(1, 0), (2, 1)] and len(log.folders(spark)) == 1


# -- cap and hot keys --------------------------------------------------------------------------------------

def test_cap_holds_over_batches_and_replays(spark, workdir):
    cap, log = EventCap(100, os.path.join(workdir, "cap")), log_at(workdir)
    run = cap.capped(log.writer())
    for k in range(4):
        run(batch_of(spark, k), k)
        run(batch_of(spark, k), k)
    assert cap.total(spark) == 100 and cap.reached(spark)
    assert stored(spark, log) == sorted([float(100 * k + i) for k in (0, 1) for i in range(40)] + [200.0 + i for i in range(20)])
    free = EventCap(0, os.path.join(workdir, "free"))
    taken = []
    free.capped(lambda b, i: taken.append(b.count()))(batch_of(spark, 0), 0)
    assert taken == [40] and not free.reached(spark)


def test_capped_query_ends_by_itself(spark, workdir):
    stage = os.path.join(workdir, "stage")
    os.makedirs(stage)
    write(os.path.join(stage, "a.json"), "\n".join(message("A", float(i), at(i)) for i in range(30)) + "\n")
    stream = parse_ticks(replay_stream(spark, stage, "text").withColumnRenamed("value", "json"))
    cap, log = EventCap(12, os.path.join(workdir, "cap")), log_at(workdir)
    query = stream.writeStream.option("checkpointLocation", os.path.join(workdir, "ck")).foreachBatch(cap.capped(log.writer())).start()
    cap.await_end(query, 0.2)
    assert not query.isActive and stored(spark, log) == [float(i) for i in range(12)]


def test_sketch_names_hot_keys_of_the_batches_before(spark, workdir):
    heavy = HeavyHitters(os.path.join(workdir, "h"), "user", share=0.1)
    batch = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(
        F.col("id")).cast("bigint").alias("user"))
    assert heavy.keys(spark, 0) == []
    for k in range(3):
        watched, seen = heavy.observed(batch)
        assert watched.count() == 3000
        heavy.record(spark, k, "bigint", seen.get)
        heavy.record(spark, k, "bigint", seen.get)
        assert heavy.keys(spark, k + 1) == [(7,)]
    assert heavy.sketched(batch)["rows"] == 3000
    assert len(os.listdir(os.path.join(workdir, "h"))) <= 2


def test_hot_key_is_dealt_over_many_tasks(spark):
    facts = spark.range(0, 24_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(
        F.col("id")).cast("bigint").alias("k"), F.col("id").alias("v")).repartition(6)
    dim = spark.range(0, 24_000).where("id % 2 = 1").select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("w"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(facts, dim, ["k"], "left", [(7,)], salts=16)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 24_000 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, joined.collect()), key=key) == sorted(map(tuple, facts.join(dim, "k", "left").collect()), key=key)


# -- ties and snapshots ------------------------------------------------------------------------------------

def test_one_latest_row_per_key_on_ties(spark):
    rows = [("A", 1, "x", at(5)), ("A", 1, "y", at(5)), ("A", 2, "z", at(1)), (None, 1, "n", at(3)), (None, 1, "m", at(3)),
            ("\x00", 1, "zero", at(9)), ("", 1, "empty", at(2)), ("B", 1, "same", at(2)), ("B", 1, "same", at(2))]
    df = spark.createDataFrame(rows, "symbol string, tie int, name string, timestamp timestamp")
    for order in (("timestamp",), ("timestamp", "tie")):
        found = [tuple(r) for r in latest_per_key(df, order=order, columns=["name"]).collect()]
        assert len(found) == 5
        one = dict(found)
        assert one["A"] in "xy" and one[None] in "nm" and (one["\x00"], one[""], one["B"]) == ("zero", "empty", "same")
        again = latest_per_key(df.repartition(5), order=order, columns=["name"])
        assert dict(tuple(r) for r in again.collect()) == one


def test_snapshots_are_shaped_without_a_shuffle(spark, workdir):
    rows = [(1, 200, '{"bitcoin":{"usd":1.5},"ethereum":{"usd":2}}', at(0)), (2, 200, "{}", at(1)), (3, 500, "{}", at(2))]
    df = spark.createDataFrame(rows, "id int, status int, body string, fetched_at timestamp")
    split = snapshot_split(df, keep=("id",))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("from_json") <= 2  # the body, and no asset literal left
    found = {r["id"]: ([q["symbol"] for q in r["quotes"] or []], r["reason"]) for r in split.collect()}
    assert found == {1: (["BTC", "ETH"], None), 2: ([], "no_prices"), 3: ([], "http_status")}
