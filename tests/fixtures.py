"""Small in-test inputs mirroring the original project's test feeds (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

NOW = dt.datetime(2026, 5, 7, 12, 0, 0)
OLD = NOW - dt.timedelta(minutes=5)


def iso(t: dt.datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


# The end-to-end feed of the original tests, three BTC ticks and one ETH tick, the last
# at "now" (here a fixed instant).
FEED = [
    ("BTC", 100.0, OLD),
    ("BTC", 120.0, OLD + dt.timedelta(seconds=10)),
    ("ETH", 50.0, OLD + dt.timedelta(seconds=20)),
    ("BTC", 150.0, NOW),
]


def feed_json() -> list[str]:
    return ['{"symbol":"%s","price":%s,"timestamp":"%s"}' % (s, p, iso(t)) for s, p, t in FEED]


# The metadata dimension of the original deployment (header CSV, all text).
METADATA_CSV = """symbol,coin_name,category
BTC,Bitcoin,Store of Value
ETH,Ethereum,Smart Contracts
SOL,Solana,Smart Contracts
ADA,Cardano,Smart Contracts
DOGE,Dogecoin,Meme Coin
BNB,BNB,Exchange Token
XRP,XRP,Payments
DOT,Polkadot,Interoperability
AVAX,Avalanche,Smart Contracts
MATIC,Polygon,Scaling
"""

TICKS_NTZ = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])


def write(path: str, text: str) -> str:
    with open(path, "w") as fh:
        fh.write(text)
    return path
