"""The shared benchmark tables seen as the price-tick data model.

``events`` stands for the tick stream: symbol = ``event_type``, price = ``value``, event time = ``ts``
(TIMESTAMP_NTZ holding UTC wall-clock time), tie-breaker = ``event_id``. ``customer`` stands for the
static dimension, keyed by ``events.user_id = c_custkey``: ``c_name`` plays the name and ``c_mktsegment``
the category. Every derived feed below is a per-row projection of ``events``, so its size grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.encode import iso_instant, tick_json


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _user() -> Column:
    """The event's user; for ``event_id % 5 = 0`` negated, an id no customer has, so those ticks stay unmatched."""
    return F.when(F.col("event_id") % 5 == 0, -F.col("user_id")).otherwise(F.col("user_id"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, user_id, symbol, price, timestamp`` (event time as TIMESTAMP_NTZ)."""
    return load(spark, sf_dir, "events").select(
        "event_id", _user().alias("user_id"), F.col("event_type").alias("symbol"),
        F.col("value").alias("price"), F.col("ts").alias("timestamp"))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, coin_name, category`` from ``customer``."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("coin_name"),
        F.col("c_mktsegment").alias("category"))


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the JSON message a producer would publish: ``event_id, user_id, json``."""
    return load(spark, sf_dir, "events").select(
        "event_id", _user().alias("user_id"), tick_json("event_type", "value", "ts").alias("json"))


def id_messages(spark: SparkSession, sf_dir: str, hot_user: bool = False) -> DataFrame:
    """``ts, json``: every event as a message that also carries its user and its id; with ``hot_user`` every third
    event is user 1's."""
    user = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(_user()) if hot_user else _user()
    body = F.to_json(F.struct(F.col("event_type").alias("symbol"), F.col("value").alias("price"),
                              iso_instant("ts").alias("timestamp"), user.alias("user_id"), "event_id"))
    return load(spark, sf_dir, "events").select("ts", body.alias("json"))


# Fixed fixture rule: which events are published damaged, and how (residues of event_id).
def damaged_messages(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Every event as a JSON message, some damaged the ways a real feed is:

    ``event_id % 19 = 0`` not JSON at all; ``% 17 = 1`` price as a JSON string; ``% 13 = 2`` symbol key
    in upper case; ``% 11 = 3`` timestamp text unreadable; ``% 7 = 4`` price ``NaN`` as text; otherwise a
    clean message. Strict parsing must keep exactly the clean ones.
    """
    e = load(spark, sf_dir, "events")
    sym, val, ts, eid = F.col("event_type"), F.col("value"), F.col("ts"), F.col("event_id")
    q = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
    body = (F.when(eid % 19 == 0, F.lit("not json at all"))
            .when(eid % 17 == 1, F.to_json(F.struct(sym.alias("symbol"), val.cast("string").alias("price"),
                                                   iso_instant(ts).alias("timestamp"))))
            .when(eid % 13 == 2, F.to_json(F.struct(sym.alias("SYMBOL"), val.alias("price"),
                                                   iso_instant(ts).alias("timestamp"))))
            .when(eid % 11 == 3, F.concat(F.lit('{"symbol":'), q(sym), F.lit(',"price":'),
                                          val.cast("string"), F.lit(',"timestamp":"yesterday"}')))
            .when(eid % 7 == 4, F.concat(F.lit('{"symbol":'), q(sym),
                                         F.lit(',"price":"NaN","timestamp":'), q(iso_instant(ts)),
                                         F.lit("}")))
            .otherwise(tick_json(sym, val, ts)))
    return e.select(*keep, body.alias("json"))


def loose_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a loosely typed text feed (``symbol, price, timestamp`` all text), some values bad:

    ``event_id % 19 = 0`` no symbol; ``% 7 = 3`` price ``n/a``; ``% 13 = 5`` price ``NaN``;
    ``% 11 = 4`` timestamp ``not-a-time``; ``% 3 = 1`` timestamp with a ``+02:00`` offset (same instant);
    other timestamps end in ``Z``.
    """
    e = load(spark, sf_dir, "events")
    eid = F.col("event_id")
    price = (F.when(eid % 7 == 3, F.lit("n/a")).when(eid % 13 == 5, F.lit("NaN"))
             .otherwise(F.col("value").cast("string")))
    shifted = F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamp = (F.when(eid % 11 == 4, F.lit("not-a-time"))
             .when(eid % 3 == 1, F.concat(shifted, F.lit("+02:00")))
             .otherwise(iso_instant("ts")))
    symbol = F.when(eid % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    return e.select("event_id", symbol.alias("symbol"), price.alias("price"), stamp.alias("timestamp"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price-API response per event: ``snapshot_id, status, body, fetched_at``.

    The body quotes the event's own asset (``event_type``) plus ``tether`` at 1.0. Fixture rule:
    ``event_id % 17 = 0`` answered 503; ``% 5 = 2`` own quote is null; ``% 5 = 3`` own quote lacks ``usd``;
    ``% 4 = 1`` the quote has more digits than a double holds; ``% 23 = 5`` it is 1E+25; ``% 7 = 1`` the own
    asset is quoted twice, at 1 first; ``% 3 = 0`` it was fetched at a whole second.
    """
    e = load(spark, sf_dir, "events")
    eid = F.col("event_id")
    quote = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
    price = (F.when(eid % 23 == 5, F.lit("1E+25"))
             .when(eid % 4 == 1, F.concat(F.floor("value").cast("string"), F.lit(".450000000000000000001")))
             .otherwise(F.col("value").cast("string")))
    own = (F.when(eid % 5 == 2, F.lit('{"usd":null}'))
           .when(eid % 5 == 3, F.concat(F.lit('{"eur":'), price, F.lit("}")))
           .otherwise(F.concat(F.lit('{"usd":'), price, F.lit("}"))))
    twice = F.when(eid % 7 == 1, F.concat(quote(F.col("event_type")), F.lit(':{"usd":1},'))).otherwise("")
    body = F.concat(F.lit("{"), twice, quote(F.col("event_type")), F.lit(":"), own,
                    F.lit(',"tether":{"usd":1.0}}'))
    status = F.when(eid % 17 == 0, F.lit(503)).otherwise(F.lit(200))
    fetched = F.when(eid % 3 == 0, F.date_trunc("second", "ts").cast("timestamp_ntz")).otherwise(F.col("ts"))
    return e.select(eid.alias("snapshot_id"), status.alias("status"), body.alias("body"),
                    fetched.alias("fetched_at"))
