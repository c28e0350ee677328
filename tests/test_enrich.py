"""Left enrichment with the static dimension, and the size-checked lookup join behind it."""

import os

import pytest
from pyspark.sql import functions as F

from tickwise.operators.enrich import enrich
from tickwise.operators.joins import assert_unique_keys, check_size, heavy_keys, lookup_join
from tickwise.plans.dashboard import enrich_with_metadata
from tickwise.sources.files import read_metadata

from fixtures import FEED, METADATA_CSV, TICKS_NTZ, write


def _feed(spark, extra=()):
    return spark.createDataFrame(list(FEED) + list(extra), TICKS_NTZ)


def _meta(spark, workdir, text=METADATA_CSV):
    return read_metadata(spark, write(os.path.join(workdir, "meta.csv"), text))


def test_left_join_keeps_unmatched(spark, workdir):
    out = enrich(_feed(spark, [("ZZZ", 1.0, FEED[0][2])]), _meta(spark, workdir))
    assert out.columns == ["symbol", "coin_name", "category", "price", "timestamp"]
    rows = {(r["symbol"], r["coin_name"], r["category"]) for r in out.collect()}
    assert rows == {("BTC", "Bitcoin", "Store of Value"), ("ETH", "Ethereum", "Smart Contracts"),
                    ("ZZZ", None, None)}
    assert out.count() == 5


def test_small_dimension_is_broadcast(spark, workdir):
    plan = enrich(_feed(spark), _meta(spark, workdir))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_duplicate_keys_multiply_or_raise(spark, workdir):
    meta = _meta(spark, workdir, METADATA_CSV + "BTC,Bitcoin Again,Other\n")
    assert enrich(_feed(spark), meta).count() == 7
    with pytest.raises(ValueError, match="not unique"):
        enrich(_feed(spark), meta, check_unique=True)
    with pytest.raises(ValueError):
        assert_unique_keys(meta, "symbol")


def test_missing_and_header_only_metadata(spark, workdir):
    missing = read_metadata(spark, os.path.join(workdir, "absent.csv"))
    assert missing.count() == 0 and missing.columns == ["symbol", "coin_name", "category"]
    header_only = _meta(spark, workdir, "symbol,coin_name,category\n")
    assert header_only.count() == 0
    prices = _feed(spark).withColumn("coin_name", F.lit("kept")).withColumn("category", F.lit("kept"))
    # Empty metadata leaves the prices as they are.
    assert enrich_with_metadata(prices, missing).filter("coin_name = 'kept'").count() == 4
    # Non-empty metadata replaces the columns.
    assert enrich_with_metadata(prices, _meta(spark, workdir)).filter("coin_name = 'kept'").count() == 0


def test_size_check_is_bounded(spark):
    big = spark.range(0, 5000).withColumn("s", F.lit("abcdefgh"))
    small = check_size(big, max_rows=10_000)
    assert small.bounded and small.rows == 5000 and small.bytes >= 5000 * 8
    capped = check_size(big, max_rows=100)
    assert not capped.bounded and capped.rows == 5000 and capped.bytes == -1
    assert not check_size(big, max_rows=10_000, max_bytes=1000).bounded


def test_split_join_matches_broadcast(spark):
    # One hot key holds most of the facts, another has no lookup row, some are null.
    facts = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).when(F.col("id") % 3 == 1, 7).when(F.col("id") % 6 == 2, 99)
        .alias("k"), F.col("id").alias("v"))
    dim = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    key = lambda r: tuple((x is None, x) for x in r)
    expected = sorted(map(tuple, facts.join(dim, "k", "left").collect()), key=key)
    split = lookup_join(facts, dim, "k", "left", broadcast=False)
    assert sorted(map(tuple, split.select("k", "v", "w").collect()), key=key) == expected
    assert set(heavy_keys(facts, ["k"], 0.1)) == {(7,), (99,)}
    bcast = lookup_join(facts, dim, "k", "left")
    assert sorted(map(tuple, bcast.select("k", "v", "w").collect()), key=key) == expected
    inner = lookup_join(facts, dim.filter("k < 10"), "k", "inner", broadcast=False)
    assert inner.count() == facts.filter("k < 10").count()


def test_hot_key_never_reaches_the_shuffle(spark):
    facts = spark.range(0, 30000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(1).alias("k"),
                                         F.col("id").alias("v"))
    dim = spark.range(0, 30000).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    plan = lookup_join(facts, dim, "k", "left", broadcast=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "strategy=broadcast" in plan and "strategy=merge" in plan


def test_split_join_with_a_map_column(spark):
    facts = spark.range(0, 100).select((F.col("id") % 3).alias("k"),
                                       F.create_map(F.lit("a"), F.col("id")).alias("m"))
    dim = spark.range(0, 3).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    assert lookup_join(facts, dim, "k", "left", broadcast=False).count() == 100
