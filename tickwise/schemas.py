"""Fixed schemas of the price-tick data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Parsed tick: what one JSON message carries.
TICK = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])
TICK_FIELDS = [f.name for f in TICK.fields]

# Static dimension read from a header CSV: every column is text, nothing is inferred.
METADATA = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("coin_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
])
METADATA_FIELDS = [f.name for f in METADATA.fields]

# Enriched tick, the layout of the stored table.
ENRICHED = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("coin_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])
ENRICHED_FIELDS = [f.name for f in ENRICHED.fields]

ENRICHED_DDL = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in ENRICHED.fields)

# Price-API response: an open set of asset ids, each with a USD quote kept as the number's own text, so that
# no size or precision is lost before it is put on the wire or cast.
SNAPSHOT_BODY = T.MapType(T.StringType(), T.StructType([
    T.StructField("usd", T.StringType(), True),
]))
