"""Tick parsing: strict JSON parsing for the stream, lenient normalisation for loosely typed feeds.

Both are column expressions over any DataFrame, batch or streaming, and stay inside Spark's JVM operators.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.schemas import TICK


def bytes_to_text(df: DataFrame, source: str = "value", alias: str = "json") -> DataFrame:
    """Kafka-style binary payload to text (``CAST(value AS STRING)``)."""
    return df.select(F.col(source).cast("string").alias(alias))


def parse_ticks(df: DataFrame, json_col: str = "json", schema: T.StructType = TICK,
                keep: Sequence[str] = (), required: Sequence[str] | None = None) -> DataFrame:
    """Strict parse of one JSON tick per row.

    Rows whose text is null or empty, is not a JSON object, or lacks a usable symbol, price or timestamp
    are dropped; NaN prices count as missing. The JSON is parsed exactly once per row: wrapping the parsed
    struct in a one-element array and expanding it with ``inline`` stops the optimizer from copying the
    ``from_json`` call into every pushed-down filter. A null struct becomes a row of nulls, which the
    null filter below removes, so no separate ``IS NOT NULL`` step is needed.

    ``keep`` passes columns of the input through unchanged (for example a tie-breaker id).
    """
    fields = [f.name for f in schema.fields]
    parsed = df.select(*keep, F.inline(F.array(F.from_json(F.col(json_col), schema))))
    return parsed.na.drop(subset=list(required or fields))


#: What a rejected message lacks, in the order in which it is looked for.
NO_TEXT, NOT_JSON = "empty", "not_json"


def split_messages(df: DataFrame, json_col: str = "json", schema: T.StructType = TICK, keep: Sequence[str] = (),
                   required: Sequence[str] | None = None) -> DataFrame:
    """One parse for both outcomes: ``keep``, the message text, the tick's fields and ``reject_reason``.

    The reason is null exactly for the rows :func:`parse_ticks` keeps. Others tell why: ``empty`` (null or blank
    text), ``not_json`` (no JSON object), or ``no_<field>`` for the first required field without a usable value
    (absent, null, of the wrong kind, or NaN). Every message comes out once, whichever it is.
    """
    fields = [f.name for f in schema.fields]
    text = F.col(json_col)
    parsed = df.select(*keep, text.alias("message"), F.inline(F.array(F.from_json(text, schema))))
    nan = {f.name for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    unusable = {c: F.col(c).isNull() | F.isnan(c) if c in nan else F.col(c).isNull() for c in required or fields}
    reason = F.when(F.coalesce(F.trim("message") == "", F.lit(True)), NO_TEXT)
    nothing = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in fields])
    # Without any field it is told apart from an object that lacks them; only such rows are looked at again.
    like = F.trim("message").startswith("{") & F.get_json_object("message", "$").isNotNull()
    reason = reason.when(nothing & ~F.coalesce(like, F.lit(False)), NOT_JSON)
    for column, missing in unusable.items():
        reason = reason.when(missing, f"no_{column}")
    return parsed.withColumn("reject_reason", reason)


def accepted(split: DataFrame) -> DataFrame:
    """The ticks of a split: the columns kept and the parsed fields."""
    return split.where(F.col("reject_reason").isNull()).drop("reject_reason", "message")


def rejected(split: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The rejected messages of a split: ``keep``, message, reject_reason."""
    return split.where(F.col("reject_reason").isNotNull()).select(*keep, "message", "reject_reason")


def counted(split: DataFrame, name: str = "messages") -> DataFrame:
    """The split, observed: messages, accepted and rejected arrive with the query's progress (``observedMetrics``)
    on a stream and through :class:`pyspark.sql.Observation` in a batch, without a pass of their own."""
    bad = F.col("reject_reason").isNotNull()
    return split.observe(name, F.count(F.lit(1)).alias("messages"), F.count_if(~bad).alias("accepted"),
                         F.count_if(bad).alias("rejected"))


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def normalize_prices(df: DataFrame, symbol: str = "symbol", price: str = "price",
                     timestamp: str = "timestamp",
                     defaults: Sequence[str] = ("coin_name", "category")) -> DataFrame:
    """Lenient normalisation of a loosely typed price feed.

    Price and timestamp may arrive as text or as typed values: unparseable values become null, rows
    without symbol, price (or with a NaN price) or timestamp are dropped. Text timestamps carrying a zone
    are converted to the instant and returned as UTC wall-clock time (TIMESTAMP_NTZ); text without a zone
    is read as UTC; numeric timestamps are epoch seconds. Missing descriptive columns are added as empty
    strings.
    """
    dtype = dict(df.dtypes)
    price_expr = F.col(price).try_cast("double") if dtype[price] != "double" else F.col(price)
    ts_type = dtype[timestamp]
    if ts_type == "timestamp_ntz":
        ts_expr = F.col(timestamp)
    elif ts_type == "timestamp":
        ts_expr = F.col(timestamp).cast("timestamp_ntz")
    elif ts_type in ("tinyint", "smallint", "int", "bigint", "float", "double") or ts_type.startswith("decimal"):
        # Numbers are epoch seconds, as the strict JSON parser reads them.
        ts_expr = F.timestamp_seconds(F.col(timestamp)).cast("timestamp_ntz")
    else:
        ts_expr = _text(timestamp).try_cast("timestamp").cast("timestamp_ntz")
    out = df.withColumns({price: price_expr, timestamp: ts_expr})
    out = out.na.drop(subset=[symbol, price, timestamp])
    missing = {c: F.lit("") for c in defaults if c not in dtype}
    return out.withColumns(missing) if missing else out


# A loosely typed message: every field as its own text.
_LOOSE_MESSAGE = T.StructType([T.StructField(c, T.StringType(), True) for c in ("symbol", "price", "timestamp")])


def loose_messages(df: DataFrame, json_col: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """One JSON message per row as loose ``symbol, price, timestamp`` texts for :func:`normalize_prices`.

    Numbers and quoted numbers both become text; epoch-second numbers become readable timestamps. What is
    no JSON object becomes a row of nulls, which the normaliser drops.
    """
    parsed = df.select(*keep, F.inline(F.array(F.from_json(F.col(json_col), _LOOSE_MESSAGE))))
    seconds = F.col("timestamp").try_cast("double")
    stamp = F.when(seconds.isNotNull(), F.concat(F.timestamp_seconds(seconds).cast("timestamp_ntz").cast("string"),
                                                 F.lit("Z"))).otherwise(F.col("timestamp"))
    return parsed.withColumn("timestamp", stamp)
