"""Strict parsing, lenient normalisation and serialisation of ticks."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings as hsettings, strategies as st
from pyspark.sql import functions as F

from tickwise.functions.encode import kafka_records, tick_json
from tickwise.functions.parse import bytes_to_text, normalize_prices, parse_ticks
from tickwise.schemas import TICK

from fixtures import feed_json

UTC_NOON = dt.datetime(2026, 5, 7, 12, 0, 0)


def _parse(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, json string")
    rows = parse_ticks(df, keep=("id",)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return {r["id"]: (r["symbol"], r["price"], r["timestamp"]) for r in rows.collect()}


# (input text, expected (symbol, price, timestamp) or None when the row must be dropped)
CASES = [
    (None, None),
    ("", None),
    ("garbage", None),
    ("{}", None),
    ('[{"symbol":"BTC","price":1.0,"timestamp":"2026-05-07T12:00:00Z"}]', None),
    ('{"symbol":"BTC","price":"1.5","timestamp":"2026-05-07T12:00:00Z"}', None),
    ('{"symbol":"BTC","price":"NaN","timestamp":"2026-05-07T12:00:00Z"}', None),
    ('{"symbol":"BTC","price":1.5,"timestamp":"not a time"}', None),
    ('{"SYMBOL":"BTC","price":1.5,"timestamp":"2026-05-07T12:00:00Z"}', None),
    ('{"symbol":"BTC","price":1.5}', None),
    ('{"symbol":5,"price":1.5,"timestamp":"2026-05-07T12:00:00Z"}', ("5", 1.5, UTC_NOON)),
    ('{"symbol":"","price":1.5,"timestamp":"2026-05-07T12:00:00Z"}', ("", 1.5, UTC_NOON)),
    ('{"symbol":"BTC","price":-2.5,"timestamp":"2026-05-07T12:00:00Z"}', ("BTC", -2.5, UTC_NOON)),
    ('{"symbol":"BTC","price":7,"timestamp":"2026-05-07T12:00:00Z"}', ("BTC", 7.0, UTC_NOON)),
    ('{"symbol":"BTC","price":1.5,"timestamp":"2026-05-07T14:00:00+02:00"}', ("BTC", 1.5, UTC_NOON)),
    ('{"symbol":"BTC","price":1.5,"timestamp":"2026-05-07T12:00:00"}', ("BTC", 1.5, UTC_NOON)),
    ('{"symbol":"BTC","price":1.5,"timestamp":"2026-05-07T12:00:00.123456789Z"}',
     ("BTC", 1.5, UTC_NOON.replace(microsecond=123456))),
    ('{"symbol":"BTC","price":1.0,"price":2.0,"timestamp":"2026-05-07T12:00:00Z"}', ("BTC", 2.0, UTC_NOON)),
]


def test_strict_parse_cases(spark):
    got = _parse(spark, [c[0] for c in CASES])
    for i, (text, expected) in enumerate(CASES):
        assert got.get(i) == expected, f"input {text!r}: got {got.get(i)!r}, want {expected!r}"


def test_numeric_timestamp_is_epoch_seconds(spark):
    got = _parse(spark, ['{"symbol":"BTC","price":1.0,"timestamp":1778155200}'])
    assert got[0] == ("BTC", 1.0, UTC_NOON)


def test_parse_once_in_plan(spark):
    df = spark.createDataFrame([(t,) for t in feed_json()], "json string")
    plan = parse_ticks(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_same_rows_as_select_filter_drop_shape(spark):
    """The parse-once form keeps exactly the rows of the straightforward select/filter/na.drop form."""
    texts = [c[0] for c in CASES] + feed_json()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, json string")
    plain = (df.select("id", F.from_json("json", TICK).alias("data")).filter(F.col("data").isNotNull())
             .select("id", "data.symbol", "data.price", "data.timestamp")
             .na.drop(subset=["symbol", "price", "timestamp"]))
    fast = parse_ticks(df, keep=("id",))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, fast.collect()))


def test_tick_json_layout(spark):
    df = spark.createDataFrame([("BTC", 65231.45, dt.datetime(2026, 5, 7, 12, 0, 0))],
                               "symbol string, price double, timestamp timestamp_ntz")
    text = df.select(tick_json().alias("j")).first()["j"]
    assert text == '{"symbol":"BTC","price":65231.45,"timestamp":"2026-05-07T12:00:00Z"}'


def test_round_trip_exact(spark):
    rows = [("BTC", 0.1 + 0.2, dt.datetime(2024, 1, 1, 0, 0, 7, 179575)),
            ("ETH", 3210.2, dt.datetime(2026, 5, 8, 20, 42, 33)),
            ("SOL", 1e-7, dt.datetime(1999, 12, 31, 23, 59, 59, 999999))]
    df = spark.createDataFrame(rows, "symbol string, price double, timestamp timestamp_ntz")
    back = parse_ticks(df.select(tick_json().alias("json")))
    back = back.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_kafka_records(spark):
    df = spark.createDataFrame([("BTC", 1.5, dt.datetime(2026, 5, 7, 12, 0, 0))],
                               "symbol string, price double, timestamp timestamp_ntz")
    r = kafka_records(df).first()
    assert r["key"] == "BTC" and r["value"].startswith('{"symbol":"BTC","price":1.5,')


def test_lenient_normalise(spark):
    rows = [("BTC", "1.5", "2026-05-07T12:00:00Z"),
            ("BTC", "n/a", "2026-05-07T12:00:00Z"),
            ("BTC", "NaN", "2026-05-07T12:00:00Z"),
            ("ETH", "2", "2026-05-07T14:00:00+02:00"),
            ("ETH", "3", "garbage"),
            (None, "3", "2026-05-07T12:00:00Z")]
    df = spark.createDataFrame(rows, "symbol string, price string, timestamp string")
    out = normalize_prices(df).orderBy("symbol").collect()
    assert [(r["symbol"], r["price"], r["timestamp"], r["coin_name"], r["category"]) for r in out] == [
        ("BTC", 1.5, UTC_NOON, "", ""), ("ETH", 2.0, UTC_NOON, "", "")]


def test_lenient_normalise_keeps_existing_columns(spark):
    df = spark.createDataFrame([("BTC", 1.0, UTC_NOON, "Bitcoin", "SoV")],
                               "symbol string, price double, timestamp timestamp_ntz, coin_name string, "
                               "category string")
    r = normalize_prices(df).first()
    assert (r["coin_name"], r["category"]) == ("Bitcoin", "SoV")


@pytest.mark.parametrize("price", [float("nan")])
def test_nan_price_dropped_from_typed_input(spark, price):
    df = spark.createDataFrame([("BTC", price, UTC_NOON)], "symbol string, price double, timestamp timestamp_ntz")
    assert normalize_prices(df).count() == 0 and math.isnan(price)

_TICKS = st.lists(st.tuples(
    st.text(alphabet=st.characters(blacklist_categories=("Cs",)), min_size=0, max_size=12),
    st.floats(allow_nan=False, allow_infinity=False, width=64),
    st.datetimes(min_value=dt.datetime(1970, 1, 2), max_value=dt.datetime(2200, 1, 1))),
    min_size=1, max_size=20)


@hsettings(max_examples=8, deadline=None)
@given(_TICKS)
def test_round_trip_property(spark, rows):
    """Any symbol text, any finite double and any instant survive tick_json -> parse_ticks unchanged."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "id int, symbol string, price double, timestamp timestamp_ntz")
    back = parse_ticks(df.select("id", tick_json().alias("json")), keep=("id",))
    back = back.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert sorted(map(tuple, back.collect())) == sorted((i, *r) for i, r in enumerate(rows))


def test_bytes_to_text_then_parse(spark):
    df = spark.createDataFrame([(bytearray(t.encode()),) for t in feed_json()], "value binary")
    assert parse_ticks(bytes_to_text(df)).count() == 4


def test_lenient_numeric_timestamps_are_epoch_seconds(spark):
    df = spark.createDataFrame([("BTC", "1.5", 1778155200), ("ETH", "2", None)],
                               "symbol string, price string, timestamp bigint")
    assert [(r["symbol"], r["timestamp"]) for r in normalize_prices(df).collect()] == [("BTC", UTC_NOON)]
