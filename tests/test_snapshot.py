"""Price-API snapshots to ticks, and rejected responses."""

import datetime as dt
from tickwise.functions.snapshot import DEFAULT_ASSETS, snapshot_quotes, snapshot_rejects, snapshot_ticks

FETCHED = dt.datetime(2026, 5, 8, 20, 42, 33)


def _snapshots(spark, rows):
    return spark.createDataFrame([(i, s, b, FETCHED) for i, (s, b) in enumerate(rows)],
                                 "id int, status int, body string, fetched_at timestamp_ntz")


def _ticks(spark, rows, assets=DEFAULT_ASSETS):
    out = snapshot_ticks(_snapshots(spark, rows), assets, keep=("id",))
    return sorted((r["id"], r["symbol"], r["price"], r["timestamp"]) for r in out.collect())


def test_two_assets_same_timestamp(spark):
    body = '{"bitcoin":{"usd":65231.45},"ethereum":{"usd":3210.20}}'
    assert _ticks(spark, [(200, body)]) == [(0, "BTC", 65231.45, FETCHED), (0, "ETH", 3210.2, FETCHED)]


def test_missing_asset_is_skipped(spark):
    assert _ticks(spark, [(200, '{"bitcoin":{"usd":65231.45}}')]) == [(0, "BTC", 65231.45, FETCHED)]


def test_null_quote_no_usd_unknown_asset_skipped(spark):
    body = '{"bitcoin":{"usd":null},"ethereum":{"eur":1.0},"dogecoin":{"usd":0.1},"solana":{"usd":150}}'
    assert _ticks(spark, [(200, body)]) == [(0, "SOL", 150.0, FETCHED)]


def test_exact_price_text_until_cast(spark):
    body = '{"bitcoin":{"usd":65231.450000000000000001},"ethereum":{"usd":1e25}}'
    quotes = {r["symbol"]: r["price_text"] for r in snapshot_quotes(_snapshots(spark, [(200, body)])).collect()}
    assert quotes == {"BTC": "65231.450000000000000001", "ETH": "1e25"}
    assert _ticks(spark, [(200, body)]) == [(0, "BTC", 65231.45, FETCHED), (0, "ETH", 1e25, FETCHED)]


def test_last_entry_of_a_repeated_id_counts(spark):
    body = '{"bitcoin":{"usd":1},"ethereum":{"usd":5},"bitcoin":{"usd":2},"ethereum":{"usd":null}}'
    assert _ticks(spark, [(200, body)]) == [(0, "BTC", 2.0, FETCHED)]


def test_several_symbols_for_one_id(spark):
    assets = (("bitcoin", "BTC"), ("bitcoin", "XBT"))
    assert [t[1] for t in _ticks(spark, [(200, '{"bitcoin":{"usd":1}}')], assets)] == ["BTC", "XBT"]


def test_many_assets_from_a_table(spark):
    assets = spark.range(20_000).selectExpr("concat('a', id) as asset_id", "concat('S', id) as symbol")
    assert [t[1] for t in _ticks(spark, [(200, '{"a19999":{"usd":1}}')], assets)] == ["S19999"]


def test_rejects(spark):
    rows = [(200, '{"bitcoin":{"usd":1.0}}'),   # fine
            (503, '{"bitcoin":{"usd":1.0}}'),   # bad status: no ticks at all
            (200, '{"dogecoin":{"usd":1.0}}'),  # nothing configured
            (200, 'not json'),                  # unreadable body
            (None, '{"bitcoin":{"usd":1.0}}')]  # no status
    assert _ticks(spark, rows) == [(0, "BTC", 1.0, FETCHED)]
    rej = snapshot_rejects(_snapshots(spark, rows), keep=("id",))
    assert sorted((r["id"], r["reason"]) for r in rej.collect()) == [
        (1, "http_status"), (2, "no_prices"), (3, "no_prices"), (4, "http_status")]
