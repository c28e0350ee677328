"""The streaming application end to end on a file feed, producer shaping, compaction and the CLI."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickwise.cli import _parser, settings_from
from tickwise.config import Settings
from tickwise.plans import catalog
from tickwise.plans.ingest import cap_events, shape
from tickwise.plans.inspection import inspect, print_report
from tickwise.streaming import app
from tickwise.streaming.queries import drain

from fixtures import METADATA_CSV, feed_json, write


def test_streaming_app_on_file_feed(spark, workdir):
    feed = os.path.join(workdir, "feed")
    os.makedirs(feed)
    write(os.path.join(feed, "ticks.json"), "\n".join(feed_json()) + "\nnot json\n")
    settings = Settings(metadata_path=write(os.path.join(workdir, "meta.csv"), METADATA_CSV),
                        output_path=os.path.join(workdir, "crypto_analytics.db"),
                        checkpoint_path=os.path.join(workdir, "checkpoints"),
                        database="tw_app", table="crypto_info")
    running = app.start(spark, settings, source="files", path=feed, analytics_sink="memory",
                        trigger={"availableNow": True})
    for q in running.queries():
        drain(q)
    assert {q.name for q in running.queries()} == {"tick_storage", "tick_window_stats"}
    stored = spark.table("`tw_app`.`crypto_info`")
    spark.catalog.refreshTable("`tw_app`.`crypto_info`")
    assert stored.count() == 4
    assert {r["coin_name"] for r in stored.collect()} == {"Bitcoin", "Ethereum"}
    stats = spark.table("tick_window_stats")
    assert stats.count() == 4 and stats.agg({"event_count": "sum"}).first()[0] == 4
    # Flat folder: only data files directly in the table folder.
    entries = [e for e in os.listdir(settings.output_path) if not e.startswith(".")]
    assert entries and all(e.endswith(".parquet") for e in entries)
    assert catalog.count_data_files(spark, settings.output_path).first()["file_count"] == len(entries)


def test_app_rejects_duplicate_metadata(spark, workdir):
    feed = os.path.join(workdir, "feed")
    os.makedirs(feed)
    settings = Settings(metadata_path=write(os.path.join(workdir, "m.csv"), METADATA_CSV + "BTC,X,Y\n"),
                        output_path=os.path.join(workdir, "out"), database="tw_app2")
    with pytest.raises(ValueError, match="not unique"):
        app.enriched_ticks(spark, settings, source="files", path=feed)


def test_ingest_shape_and_cap(spark):
    rows = [(200, '{"bitcoin":{"usd":65231.45},"ethereum":{"usd":3210.20}}', dt.datetime(2026, 5, 8, 20, 42, 33)),
            (200, '{"solana":{"usd":150}}', dt.datetime(2026, 5, 8, 20, 42, 43)),
            (500, '{"bitcoin":{"usd":1}}', dt.datetime(2026, 5, 8, 20, 42, 53))]
    snaps = spark.createDataFrame(rows, "status int, body string, fetched_at timestamp_ntz")
    res = shape(snaps)
    assert res.ticks.count() == 3 and res.rejects.count() == 1
    recs = sorted((r["key"], r["value"]) for r in res.records.collect())
    assert recs[0] == ("BTC", '{"symbol":"BTC","price":65231.45,"timestamp":"2026-05-08T20:42:33Z"}')
    capped = shape(snaps, max_events=2).ticks.collect()
    assert [r["symbol"] for r in capped] == ["BTC", "ETH"]
    assert cap_events(res.ticks, 0).count() == 3
    # Without a recorded fetch time every tick of the run gets the same current time.
    live = shape(snaps.drop("fetched_at")).ticks
    assert live.select("timestamp").distinct().count() == 1


def test_compaction(spark, workdir):
    src, dst = os.path.join(workdir, "src"), os.path.join(workdir, "dst")
    df = spark.range(0, 1000).selectExpr("cast(id as string) as symbol", "cast(id as double) as price",
                                         "timestamp_seconds(id) as timestamp")
    for i in range(5):
        df.filter(f"id % 5 = {i}").repartition(4).write.mode("append").parquet(src)
    out = catalog.compact(spark, src, dst, rows_per_file=400)
    assert out.count() == 1000 and len(out.inputFiles()) == 3
    with pytest.raises(ValueError):
        catalog.compact(spark, src, src)


def test_cli_flags_override_environment(monkeypatch):
    monkeypatch.setenv("SPARK_PARQUET_OUTPUT_PATH", "/data/env")
    args = _parser().parse_args(["inspect", "--database", "db1", "--sample-size", "5"])
    s = settings_from(args)
    assert (s.database, s.sample_size, s.output_path, s.table) == ("db1", 5, "/data/env", "crypto_info")
    args = _parser().parse_args(["stream", "--source", "files", "--path", "/feed"])
    assert args.source == "files" and args.path == "/feed"


def test_large_cap_is_exact_and_distributed(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id").alias("v"))
    expected = [r["k"] for r in df.orderBy("k").limit(1234).collect()]
    got = cap_events(df, 1234, order=("k",))
    assert sorted(r["k"] for r in got.collect()) == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan
    assert cap_events(df, 6000, order=("k",)).count() == 5000


def test_cli_inspect_end_to_end(spark, workdir):
    """`python -m tickwise inspect` in its own process over a stored folder, then over a missing one."""
    import subprocess
    import sys

    table = os.path.join(workdir, "stored")
    rows = [("BTC", "Bitcoin", "Store of Value", 100.0, dt.datetime(2026, 5, 7, 12, 0, 0)),
            ("ETH", "Ethereum", "Smart Contracts", 50.0, dt.datetime(2026, 5, 7, 12, 0, 20))]
    spark.createDataFrame(rows, "symbol string, coin_name string, category string, price double, "
                                "timestamp timestamp").write.parquet(table)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root)
    cmd = [sys.executable, "-m", "tickwise", "inspect", "--master", "local[2]", "--table-path", table,
           "--warehouse-dir", os.path.join(workdir, "wh"), "--database", "cli_db", "--sample-size", "1"]
    out = subprocess.run(cmd, cwd=workdir, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    files = len([f for f in os.listdir(table) if f.endswith(".parquet")])
    row_count = out.stdout.split("--- stored ticks")[1].split("---")[0]
    assert row_count.split() == ["record_count", "2"]
    assert f"--- data files\n{files}" in out.stdout
    cmd[cmd.index(table)] = os.path.join(workdir, "missing")
    out = subprocess.run(cmd, cwd=workdir, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "holds no data files yet" in out.stdout


def test_large_cap_with_heavy_ties(spark):
    # A third of the rows share the smallest key: the row-hash tie-break still yields exactly n rows.
    df = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
                                     .alias("k"), F.col("id").alias("v"))
    got = cap_events(df, 2500, order=("k",)).collect()
    assert len(got) == 2500
    ks = sorted(r["k"] for r in got)
    assert ks[:2000] == [0] * 2000 and ks[2000:] == sorted(r["k"] for r in df.filter("k > 0")
                                                                 .orderBy("k").limit(500).collect())


def test_cli_clear_check_end_to_end(spark, workdir):
    """`python -m tickwise clear-check`: register if absent, clear the folder, count (0), sample."""
    import subprocess
    import sys

    table = os.path.join(workdir, "stored")
    spark.createDataFrame([("BTC", "Bitcoin", "Store of Value", 100.0, dt.datetime(2026, 5, 7, 12, 0, 0))],
                          "symbol string, coin_name string, category string, price double, "
                          "timestamp timestamp").write.parquet(table)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cmd = [sys.executable, "-m", "tickwise", "clear-check", "--master", "local[2]", "--table-path", table,
           "--warehouse-dir", os.path.join(workdir, "wh"), "--database", "cli_db2"]
    out = subprocess.run(cmd, cwd=workdir, env=dict(os.environ, PYTHONPATH=root), capture_output=True,
                         text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split("--- stored ticks")[1].split()[:2] == ["record_count", "0"]
    assert os.path.isdir(table) and not [f for f in os.listdir(table) if f.endswith(".parquet")]


def test_inspection_prints_every_sampled_row(spark, workdir, capsys):
    path = os.path.join(workdir, "stored")
    (spark.range(60).selectExpr("'BTC' as symbol", "'Bitcoin' as coin_name", "'SoV' as category",
                                "cast(id as double) as price", "timestamp_seconds(id) as timestamp")
     .write.parquet(path))
    print_report(inspect(spark, Settings(database="tw_print", table="t", output_path=path, sample_size=50)))
    sample = capsys.readouterr().out.split("--- newest ticks")[1].split("---")[0]
    assert len(sample.strip().splitlines()) == 51


def test_cap_by_time_reads_only_its_hours(spark):
    df = spark.range(0, 20_000).selectExpr("cast(timestamp_seconds(id * 60) as timestamp_ntz) as timestamp", "id",
                                           "cast(id % 5 as string) as symbol")
    for n in (1, 59, 60, 61, 12_345, 20_000, 30_000):
        got = sorted(r["id"] for r in cap_events(df, n).collect())
        assert got == list(range(min(n, 20_000)))


def test_cap_keeps_equal_rows_apart(spark):
    df = spark.range(0, 2000).selectExpr("timestamp_ntz'2026-05-08 20:00:00' as timestamp", "'BTC' as symbol")
    assert cap_events(df, 777).count() == 777


def test_records_carry_prices_as_quoted(spark):
    when = dt.datetime(2026, 5, 8, 20, 42, 33, 120000)
    body = '{"bitcoin":{"usd":65231.450000000000000001},"ethereum":{"usd":0.00000123},"solana":{"usd":1E+25}}'
    res = shape(spark.createDataFrame([(200, body, when)], "status int, body string, fetched_at timestamp_ntz"))
    values = {r["key"]: r["value"] for r in res.records.collect()}
    assert values["BTC"] == '{"symbol":"BTC","price":65231.450000000000000001,"timestamp":"2026-05-08T20:42:33.120Z"}'
    assert '"price":0.00000123,' in values["ETH"] and '"price":1E+25,' in values["SOL"]
    assert {r["symbol"]: r["price"] for r in res.ticks.collect()}["SOL"] == 1e25


def test_running_stream_keeps_its_checked_dimension(spark, workdir):
    """A key that becomes a duplicate, or a file that outgrows the bound, while the stream runs multiplies nothing;
    the next start checks the file as it is then."""
    feed = os.path.join(workdir, "feed")
    os.makedirs(feed)
    meta = write(os.path.join(workdir, "meta.csv"), METADATA_CSV)
    settings = Settings(metadata_path=meta, output_path=os.path.join(workdir, "out"),
                        checkpoint_path=os.path.join(workdir, "ck"), database="tw_app3", table="t")
    running = app.start(spark, settings, source="files", path=feed, analytics_sink="memory")
    try:
        write(os.path.join(feed, "a.json"), feed_json()[0] + "\n")
        for q in running.queries():
            q.processAllAvailable()
        write(meta, METADATA_CSV + "BTC,Again,Y\nETH,Again,Y\n")
        write(os.path.join(feed, "b.json"), "\n".join(feed_json()[1:]) + "\n")
        for q in running.queries():
            q.processAllAvailable()
    finally:
        running.stop()
    assert spark.read.parquet(settings.output_path).count() == 4
    with pytest.raises(ValueError, match="not unique"):
        app.enriched_ticks(spark, settings, source="files", path=feed)
    write(meta, METADATA_CSV + "".join(f"S{i},n,c\n" for i in range(50)))
    tight = Settings(metadata_path=meta, checkpoint_path=settings.checkpoint_path, broadcast_max_rows=20)
    plan = app.enriched_ticks(spark, tight, source="files", path=feed)._jdf.queryExecution().analyzed().toString()
    assert "merge" in plan and "broadcast" not in plan
