"""Windows that a statistics query still holds open, read from its state store.

A bounded append-mode run never emits the windows that end after its last watermark. They are in the checkpoint:
Spark's state data source reads them, and the buffers of the aggregation become the same columns that the query
emits, so what was emitted and what is open together are all windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators.windows import DEFAULT_KEYS

#: The buffers of average, maximum, minimum and count, by place: their stored names repeat.
_BUFFERS = "struct<total:double,priced:bigint,max_price:double,min_price:double,event_count:bigint>"


def open_windows(spark: SparkSession, checkpoint: str, keys: Sequence[str] = DEFAULT_KEYS,
                 batch_id: int | None = None) -> DataFrame:
    """window_start, window_end, keys and statistics of every window in the state of ``window_stats_query``.

    As of the last finished batch, or of ``batch_id``. Read it while the query is stopped or running: the store is
    read as committed. In append mode these are the windows not emitted yet; in update mode those not evicted yet.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint).select("key", F.col("value").cast(_BUFFERS).alias("value"))
    return rows.select(F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
                       *[F.col(f"key.{k}").alias(k) for k in keys],
                       (F.col("value.total") / F.col("value.priced")).alias("average_price"),
                       "value.max_price", "value.min_price", "value.event_count")
