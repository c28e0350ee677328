"""Hot keys of a stream, from a mergeable frequent-items sketch that is carried from batch to batch.

While a micro-batch is written, its keys pass through an observed sketch (no pass of their own); the batch's sketch
is then merged into the running one and stored under the batch id. The next batch joins apart the keys that, by
the running sketch, hold at least a given share of all ticks so far: at most 1 / share of them. A replayed batch
finds the sketch of the batch before it and so joins as it did the first time; whichever keys the sketch names, the
join's result is the same.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwise.operators.joins import HEAVY_SHARE
from tickwise.sources.fs import delete_path, list_names, publish_text, read_text

_WIDTH = 20


class HeavyHitters:
    """The running sketch of ``key`` below ``folder`` (beside the query's checkpoint).

    ``tracked`` items bound the sketch's size; its error is a small multiple of the ticks over ``tracked``.
    """

    def __init__(self, folder: str, key: str = "symbol", share: float = HEAVY_SHARE, tracked: int | None = None):
        self.folder, self.key, self.share = folder.rstrip("/"), key, share
        self.tracked = tracked or max(64, int(8 / share))

    def _before(self, spark: SparkSession, batch_id: int) -> dict | None:
        names = [n for n in list_names(spark, self.folder) if n.endswith(".json") and n < f"{batch_id:0{_WIDTH}d}"]
        return json.loads(read_text(spark, f"{self.folder}/{max(names)}")) if names else None

    def _frame(self, spark: SparkSession, kind: str, sketches: list[str]) -> DataFrame:
        empty = spark.range(0).select(F.lit(None).cast(kind).alias("k"))
        schema = empty.agg(self._sketch("k").alias("k")).schema
        row = {f.name: None for f in schema["k"].dataType.fields} | {"maxItemsTracked": self.tracked, "itemDataTypeDDL": f"item {kind}"}
        return spark.createDataFrame([({**row, "sketch": bytearray(base64.b64decode(s))},) for s in sketches], schema)

    def _sketch(self, column: str):
        return F.expr(f"approx_top_k_accumulate(`{column}`, {self.tracked})")

    def keys(self, spark: SparkSession, batch_id: int) -> list[tuple]:
        """The keys to join apart in a micro-batch, by all batches before it."""
        state = self._before(spark, batch_id)
        if state is None or not state["rows"]:
            return []
        found = self._frame(spark, state["kind"], [state["sketch"]]).select(
            F.inline(F.expr(f"approx_top_k_estimate(k, {int(1 / self.share) + 1})"))).collect()
        least = max(2, state["rows"] * self.share)
        return [(r["item"],) for r in found if r["item"] is not None and r["count"] >= least]

    def observed(self, batch: DataFrame) -> tuple[DataFrame, Observation]:
        """The batch with the sketch of its keys gathered as it is written."""
        seen = Observation()
        return batch.observe(seen, F.count(F.lit(1)).alias("rows"), self._sketch(self.key).alias("sketch")), seen

    def sketched(self, batch: DataFrame) -> dict:
        """What :meth:`observed` gathers, by a pass over the key column."""
        return batch.agg(F.count(F.lit(1)).alias("rows"), self._sketch(self.key).alias("sketch")).first().asDict()

    def record(self, spark: SparkSession, batch_id: int, kind: str, seen: dict) -> None:
        """Merge a written batch's sketch and store the running one; a batch that is recorded already stays."""
        if read_text(spark, f"{self.folder}/{batch_id:0{_WIDTH}d}.json") is not None:
            return
        state, sketch = self._before(spark, batch_id), base64.b64encode(bytes(seen["sketch"]["sketch"])).decode()
        rows = seen["rows"]
        if state is not None:
            # Two rows in one task: a sketch cannot be combined from none.
            merged = self._frame(spark, kind, [state["sketch"], sketch]).coalesce(1).agg(
                F.expr(f"approx_top_k_combine(k, {self.tracked})").alias("k")).first()["k"]["sketch"]
            sketch, rows = base64.b64encode(bytes(merged)).decode(), rows + state["rows"]
        publish_text(spark, f"{self.folder}/{batch_id:0{_WIDTH}d}.json",
                     json.dumps({"rows": rows, "kind": kind, "sketch": sketch}))
        for name in list_names(spark, self.folder):  # the record before is kept for a replay
            if name.endswith(".json") and name < f"{batch_id - 1:0{_WIDTH}d}":
                delete_path(spark, f"{self.folder}/{name}")
