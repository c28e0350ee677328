"""Window statistics, latest values, trend buckets, the dense grid and table summaries."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickwise.config import Settings

from tickwise.operators import grid, latest, summary, windows
from tickwise.plans.dashboard import build, from_parquet, symbol_grid

from fixtures import FEED, NOW, OLD, TICKS_NTZ


def _feed(spark, extra=()):
    return spark.createDataFrame(list(FEED) + list(extra), TICKS_NTZ)


def test_two_second_windows_one_event_each(spark):
    df = _feed(spark).withColumn("coin_name", F.lit(None).cast("string")).withColumn(
        "category", F.lit(None).cast("string"))
    out = windows.window_stats(df, "2 seconds").orderBy("window_start").collect()
    assert len(out) == 4
    first = out[0]
    assert first["window_start"] == OLD and first["window_end"] == OLD + dt.timedelta(seconds=2)
    assert (first["symbol"], first["average_price"], first["max_price"], first["min_price"],
            first["event_count"]) == ("BTC", 100.0, 100.0, 100.0, 1)
    # Null keys form a group unless unmatched rows are dropped.
    assert windows.window_stats(df, "2 seconds", drop_unmatched=True).count() == 0


def test_minute_window_statistics(spark):
    rows = [("BTC", 10.0, NOW), ("BTC", 20.0, NOW + dt.timedelta(seconds=30)),
            ("BTC", 60.0, NOW + dt.timedelta(seconds=59, microseconds=999999)),
            ("BTC", 5.0, NOW + dt.timedelta(seconds=60))]
    df = spark.createDataFrame(rows, TICKS_NTZ)
    out = windows.window_stats(df, "1 minute", keys=["symbol"]).orderBy("window_start").collect()
    assert [(r["average_price"], r["max_price"], r["min_price"], r["event_count"]) for r in out] == [
        (30.0, 60.0, 10.0, 3), (5.0, 5.0, 5.0, 1)]


def test_bucket_stats_drops_unmatched_by_default(spark):
    df = _feed(spark).withColumn("coin_name", F.when(F.col("symbol") == "BTC", "Bitcoin")).withColumn(
        "category", F.lit("c"))
    out = windows.bucket_stats(df, "2 seconds")
    assert out.columns[0] == "time_bucket" and out.count() == 3


def test_latest_per_key_with_tie_breaker(spark):
    rows = [("BTC", 1.0, NOW, 1), ("BTC", 2.0, NOW, 2), ("ETH", 3.0, OLD, 3), ("ETH", 4.0, OLD, 0)]
    df = spark.createDataFrame(rows, "symbol string, price double, timestamp timestamp_ntz, id int")
    out = {r["symbol"]: (r["price"], r["id"]) for r in
           latest.latest_per_key(df, order=("timestamp", "id")).collect()}
    assert out == {"BTC": (2.0, 2), "ETH": (3.0, 3)}


def test_latest_is_partial_aggregate(spark):
    df = _feed(spark)
    plan = latest.latest_per_key(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan and "SortAggregate" not in plan


def test_last_in_bucket(spark):
    rows = [("BTC", 1.0, NOW), ("BTC", 2.0, NOW + dt.timedelta(seconds=39)),
            ("BTC", 3.0, NOW + dt.timedelta(seconds=40)), ("ETH", 4.0, NOW)]
    out = latest.last_in_bucket(spark.createDataFrame(rows, TICKS_NTZ), "40 seconds")
    assert sorted((r["symbol"], r["time_bucket"], r["price"]) for r in out.collect()) == [
        ("BTC", NOW, 2.0), ("BTC", NOW + dt.timedelta(seconds=40), 3.0), ("ETH", NOW, 4.0)]


def test_dense_grid_shape_and_values(spark):
    out = grid.dense_trend_grid(_feed(spark)).orderBy("symbol", "time_bucket").collect()
    by = {}
    for r in out:
        by.setdefault(r["symbol"], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"BTC": 17, "ETH": 17}
    # NOW is a multiple of 40 s; the grid runs from 10 minutes before the newest bucket to 40 s after it.
    btc = by["BTC"]
    assert btc[0]["time_bucket"] == NOW - dt.timedelta(minutes=10)
    assert btc[-1]["time_bucket"] == NOW + dt.timedelta(seconds=40)
    priced = [(r["time_bucket"], r["price"]) for r in btc if r["price"] is not None]
    assert priced == [(dt.datetime(2026, 5, 7, 11, 54, 40), 120.0), (NOW, 150.0)]
    assert btc[-2]["time_label"] == "12:00:00"
    only = grid.dense_trend_grid(_feed(spark), only_priced=True).count()
    assert only == 3  # BTC: two buckets in frame; ETH: one


def test_summaries(spark):
    df = _feed(spark)
    assert summary.row_count(df).first()["record_count"] == 4
    tr = summary.time_range(df).first()
    assert (tr["first_event_timestamp"], tr["latest_event_timestamp"]) == (OLD, NOW)
    assert [tuple(r) for r in summary.rows_by_key(df, ["symbol"]).collect()] == [("BTC", 3), ("ETH", 1)]
    assert [r["symbol"] for r in summary.distinct_values(df.union(
        spark.createDataFrame([(None, 1.0, NOW)], TICKS_NTZ))).collect()] == ["BTC", "ETH"]
    assert [r["price"] for r in summary.newest(df, 2).collect()] == [150.0, 50.0]
    assert summary.key_slice(df, "ETH").count() == 1
    assert summary.sample_rows(df, 2).count() == 2


def test_dashboard_build(spark):
    frames = build(_feed(spark))
    latest_rows = [(r["symbol"], r["price"]) for r in frames.latest.collect()]
    assert latest_rows == [("BTC", 150.0), ("ETH", 50.0)]
    assert frames.analytics.count() == 4
    assert [r["symbol"] for r in frames.symbols.collect()] == ["BTC", "ETH"]
    assert frames.grid.count() == 34 and frames.trends.count() == 3
    assert [r["price"] for r in symbol_grid(frames, "BTC").orderBy("time_bucket").collect()] == [120.0, 150.0]


def test_newest_values_use_hash_aggregation(spark):
    df = _feed(spark)
    fast = latest.last_in_bucket(df, "40 seconds")._jdf.queryExecution().executedPlan().toString()
    exact = latest.last_in_bucket(df.withColumn("id", F.lit(1)), "40 seconds", tie_breakers=("id",))
    named = latest.latest_per_key(df.withColumn("name", F.lit("n")))
    assert "HashAggregate" in fast and "SortAggregate" not in fast
    for other in (exact, named):
        assert "SortAggregate" not in other._jdf.queryExecution().executedPlan().toString()


def test_dashboard_from_parquet_folder(spark, workdir):
    missing = from_parquet(spark, Settings(output_path=os.path.join(workdir, "none")))
    assert missing.latest.count() == 0 and missing.analytics.count() == 0
    path = os.path.join(workdir, "stored")
    _feed(spark).withColumn("timestamp", F.col("timestamp").cast("timestamp")).select(
        "symbol", F.lit("Bitcoin").alias("coin_name"), F.lit("SoV").alias("category"), "price",
        "timestamp").write.parquet(path)
    frames = from_parquet(spark, Settings(output_path=path))
    assert [(r["symbol"], r["price"]) for r in frames.latest.collect()] == [("BTC", 150.0), ("ETH", 50.0)]


def test_latest_row_with_text_columns_nulls_and_equal_rows(spark):
    rows = [("BTC", "a", NOW, 1), ("BTC", "b", NOW, 2), ("BTC", "b", NOW, 2), (None, "c", OLD, -5), (None, "d", OLD, -6),
            ("ETH", "e", None, 9)]
    df = spark.createDataFrame(rows, "symbol string, name string, timestamp timestamp_ntz, id bigint")
    out = sorted((r["symbol"] or "", r["name"]) for r in latest.latest_per_key(df, order=("timestamp", "id")).collect())
    assert out == [("", "c"), ("BTC", "b")]


def test_grid_refuses_a_stream(spark):
    stream = spark.readStream.format("rate").load().selectExpr("'A' as symbol", "timestamp", "1.0D as price")
    with pytest.raises(ValueError, match="batch result"):
        grid.dense_trend_grid(stream)
