"""Tick serialisation: ISO-8601 instants and the JSON message / Kafka record layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_instant(ts: Column | str) -> Column:
    """Format an event time as an ISO-8601 UTC instant with no, three or six fraction digits, as needed.

    A TIMESTAMP_NTZ column is taken to hold UTC wall-clock time; a TIMESTAMP column is rendered in UTC
    (the session zone the jobs run with).
    """
    col = F.col(ts) if isinstance(ts, str) else ts
    micros = F.date_format(col, "SSSSSS")
    fraction = (F.when(micros == "000000", "").when(micros.endswith("000"), F.concat(F.lit("."), micros.substr(1, 3)))
                .otherwise(F.concat(F.lit("."), micros)))
    return F.concat(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def tick_json(symbol: Column | str = "symbol", price: Column | str = "price",
              timestamp: Column | str = "timestamp") -> Column:
    """One tick as compact JSON text: ``{"symbol":..,"price":..,"timestamp":".."}``."""
    sym = F.col(symbol) if isinstance(symbol, str) else symbol
    prc = F.col(price) if isinstance(price, str) else price
    return F.to_json(F.struct(sym.alias("symbol"), prc.alias("price"),
                              iso_instant(timestamp).alias("timestamp")))


def exact_tick_json(symbol: Column | str = "symbol", price_text: Column | str = "price_text",
                    timestamp: Column | str = "timestamp") -> Column:
    """The same layout with the price's number text put in as it was quoted, whatever its digits or size."""
    sym = F.col(symbol) if isinstance(symbol, str) else symbol
    prc = F.col(price_text) if isinstance(price_text, str) else price_text
    head = F.to_json(F.struct(sym.alias("symbol")))
    return F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"price":'), prc, F.lit(',"timestamp":"'),
                    iso_instant(timestamp), F.lit('"}'))


def kafka_records(df: DataFrame, symbol: str = "symbol", price: str = "price",
                  timestamp: str = "timestamp", keep: tuple[str, ...] = (), exact: bool = False) -> DataFrame:
    """Rows in the shape a Kafka sink takes: message key = symbol, value = tick JSON.

    ``exact``: ``price`` names a column of number texts that go to the wire unchanged.
    """
    value = (exact_tick_json if exact else tick_json)(symbol, price, timestamp)
    return df.select(*keep, F.col(symbol).cast("string").alias("key"), value.alias("value"))
