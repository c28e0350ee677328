"""Price-API snapshots to ticks.

A snapshot is one HTTP response: a status code, a JSON body mapping asset ids to ``{"usd": price}`` and the
time it was fetched. Every configured asset present with a usable USD quote yields one tick per symbol
configured for it, stamped with the snapshot's fetch time; absent assets, null quotes, quotes without ``usd``
and unknown ids are skipped, and where a body repeats an id its last entry counts. Responses outside 200-299
yield nothing and are rejected, as are successful responses without any configured price.

Each snapshot is shaped within its own row: the body is parsed once, behind a generator, and its quotes are looked
up in the asset table, a literal map. Ticks and the reason for a reject come from that one row without a join, a row
id or a shuffle, on a table as on a stream. The asset table's size is checked before it becomes a literal; one of
more rows (batch only) is joined. Prices stay number texts of any size and precision up to the wire; only the analytics
column is a double.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.config import written
from tickwise.operators.joins import lookup_join
from tickwise.schemas import SNAPSHOT_BODY

# Asset id -> ticker symbol of the default deployment, in configured order.
DEFAULT_ASSETS = (
    ("bitcoin", "BTC"),
    ("ethereum", "ETH"),
    ("solana", "SOL"),
    ("cardano", "ADA"),
    ("ripple", "XRP"),
)

#: Configured (asset, symbol) pairs that become a literal of the plan.
MAX_ASSETS = 1000

Assets = DataFrame | Iterable[tuple[str, str]] | Mapping[str, str]
_USD_NUMBER = r'((?<!\\)"usd"\s*:\s*)(-?[0-9][0-9.eE+-]*)'
_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def asset_pairs(assets: Assets) -> DataFrame | list[tuple[str, str]]:
    """The configured (asset_id, symbol) pairs: as a list when they are few, checked by count, else as a table."""
    if isinstance(assets, DataFrame):
        table = assets.select("asset_id", "symbol").na.drop().distinct()
        rows = table.limit(MAX_ASSETS + 1).collect()
        if len(rows) > MAX_ASSETS:
            return table
        pairs = sorted((r["asset_id"], r["symbol"]) for r in rows)
    else:
        pairs = list(assets.items()) if isinstance(assets, Mapping) else list(assets)
    if not pairs:
        raise ValueError("at least one asset must be configured")
    if len(pairs) > MAX_ASSETS:
        raise ValueError(f"more than {MAX_ASSETS} configured assets: pass them as a table")
    return list(dict.fromkeys((a, s) for a, s in pairs if a is not None and s is not None))


def snapshot_split(snapshots: DataFrame, assets: Assets = DEFAULT_ASSETS, status: str = "status",
                   body: str = "body", fetched_at: str = "fetched_at", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per snapshot: ``keep``, status, timestamp, ``quotes`` (symbol, price_text) and ``reason``.

    ``reason`` is null where there is a quote, else ``http_status`` or ``no_prices``.
    """
    ok = F.coalesce(F.col(status).between(200, 299), F.lit(False))
    # Put in quotes, a number reaches the string field digit by digit; bare, it would pass through a double.
    exact = F.regexp_replace(F.col(body), _USD_NUMBER, r'$1"$2"')
    entries = F.map_entries(F.from_json(F.when(ok, exact), SNAPSHOT_BODY))
    rows = snapshots.select(*keep, F.col(status).alias("_status"), F.col(fetched_at).alias("timestamp"),
                            F.inline(F.array(F.struct(entries.alias("entries")))))
    pairs = asset_pairs(assets)
    shaped = _joined(rows, pairs, keep) if isinstance(pairs, DataFrame) else _looked_up(rows, pairs, keep)
    none = F.coalesce(F.size("quotes") <= 0, F.lit(True))  # the size of a null array is not positive
    accepted = F.coalesce(F.col("_status").between(200, 299), F.lit(False))
    return shaped.select(*keep, F.col("_status").alias(status), "timestamp", "quotes",
                         F.when(none, F.when(accepted, "no_prices").otherwise("http_status")).alias("reason"))


def _last_priced(entries: str):
    """Of the (id, quote) entries the last of each id, where it has a usable price."""
    ids = F.transform(entries, lambda e: e["key"])
    # The last entry of a repeated id counts: keep those whose id does not occur behind them.
    last = F.filter(entries, lambda e, i: F.array_position(F.slice(ids, i + 2, F.size(ids) + 1), e["key"]) == 0)
    return F.filter(last, lambda e: F.coalesce(e["value"]["usd"].rlike(_NUMBER), F.lit(False)))


def _looked_up(rows: DataFrame, pairs: list[tuple[str, str]], keep: tuple[str, ...]) -> DataFrame:
    """Quotes of each row by a literal map of the few configured assets."""
    known: dict[str, list[str]] = {}
    for asset, symbol in pairs:
        known.setdefault(asset, []).append(symbol)
    symbols = F.from_json(F.lit(json.dumps(known)), "map<string, array<string>>")  # folded to a literal
    ours = F.filter("entries", lambda e: F.map_contains_key(symbols, e["key"]))
    quotes = F.flatten(F.transform(_last_priced("ours"), lambda e: F.transform(
        F.element_at(symbols, e["key"]), lambda s: F.struct(s.alias("symbol"), e["value"]["usd"].alias("price_text")))))
    return rows.select(*keep, "_status", "timestamp", F.inline(F.array(F.struct(ours.alias("ours"))))).select(
        *keep, "_status", "timestamp", F.inline(F.array(F.struct(quotes.alias("quotes")))))


def _joined(rows: DataFrame, table: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The same for an asset table too large for a literal: quotes are joined to it and gathered per snapshot."""
    numbered = written(rows.withColumn("_row", F.monotonically_increasing_id()), "snapshots")
    quoted = numbered.select("_row", F.inline(F.transform(_last_priced("entries"), lambda e: F.struct(
        e["key"].alias("asset_id"), e["value"]["usd"].alias("price_text")))))
    found = lookup_join(quoted, table, "asset_id", "inner").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("symbol", "price_text"))).alias("quotes"))
    return numbered.join(found, "_row", "left").select(*keep, "_status", "timestamp", "quotes")


def snapshot_quotes(snapshots: DataFrame, assets: Assets = DEFAULT_ASSETS, status: str = "status",
                    body: str = "body", fetched_at: str = "fetched_at", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every snapshot with its configured quotes: ``keep``, status, timestamp, symbol, price_text.

    A snapshot without a usable configured quote has one row with null symbol.
    """
    return snapshot_split(snapshots, assets, status, body, fetched_at, keep).select(
        *keep, status, "timestamp", F.inline_outer("quotes"))


def ticks_of(split: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``symbol, price, timestamp, price_text`` of every usable quote."""
    return split.select(*keep, "timestamp", F.inline("quotes")).select(
        *keep, "symbol", F.col("price_text").cast("double").alias("price"), "timestamp", "price_text")


def rejects_of(split: DataFrame, status: str = "status", keep: tuple[str, ...] = ()) -> DataFrame:
    """Snapshots that produce no tick, with the reason: ``http_status`` or ``no_prices``."""
    return split.where(F.col("reason").isNotNull()).select(*keep, status, "reason")


def snapshot_ticks(snapshots: DataFrame, assets: Assets = DEFAULT_ASSETS, status: str = "status",
                   body: str = "body", fetched_at: str = "fetched_at",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Ticks (``symbol, price, timestamp``) from accepted snapshots."""
    return ticks_of(snapshot_split(snapshots, assets, status, body, fetched_at, keep), keep).drop("price_text")


def snapshot_rejects(snapshots: DataFrame, assets: Assets = DEFAULT_ASSETS, status: str = "status",
                     body: str = "body", fetched_at: str = "fetched_at", keep: tuple[str, ...] = ()) -> DataFrame:
    return rejects_of(snapshot_split(snapshots, assets, status, body, fetched_at, keep), status, keep)
