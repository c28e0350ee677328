"""An update-mode log in tiers: many micro-batches, few folders.

Each micro-batch adds a folder of level 0. Whenever ``fan_in`` folders of a level are there, they are merged into one
of the next level that keeps, per key, the row of the newest batch. Where that fills the next level too, all levels are
merged in one pass, so no row is written twice for one micro-batch; and where one folder alone holds rows (a stream's
closing batch changes no window) that folder is listed at the next level as it is. A list of the current folders is published
whole after each step, so a reader sees the same rows before, during and after a merge, and lists a number of folders
that grows with the logarithm of the batches. Merged folders are deleted one list later, when no reader that began
before the merge needs them to start. A replayed batch writes its folder again and is listed once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.sources.fs import delete_path, list_names, publish_text, read_text
from tickwise.streaming.flat_log import PLAIN_FILES

_WIDTH = 12


def newest_of_each(log: DataFrame, keys: Sequence[str], version: str = "_batch") -> DataFrame:
    """Per key the row of the highest ``version``, by partial hash aggregation; ``version`` stays."""
    values = [c for c in log.columns if c not in keys and c != version]
    return log.groupBy(*keys).agg(*[F.max_by(F.col(c), F.col(version)).alias(c) for c in values],
                                  F.max(version).alias(version))


class TieredLog:
    def __init__(self, path: str, keys: Sequence[str], fan_in: int = 4):
        if fan_in < 2:
            raise ValueError("a merge takes two folders at least")
        self.path, self.keys, self.fan_in = path.rstrip("/"), list(keys), fan_in

    # A list: {"step": number, "folders": [[level, first batch, last batch, folder, has rows], ...], "gone": [folder, ...]}
    def _list(self, spark: SparkSession) -> dict:
        names = [n for n in list_names(spark, f"{self.path}/lists") if n.endswith(".json")]
        if not names:
            return {"step": -1, "folders": [], "gone": []}
        found = json.loads(read_text(spark, f"{self.path}/lists/{max(names)}"))
        # Lists of three parts a folder are older: such a folder has its own name and counts as one with rows.
        return found | {"folders": [f if len(f) > 3 else [*f, self._name(*f), True] for f in found["folders"]]}

    @staticmethod
    def _name(level: int, first: int, last: int) -> str:
        return f"level={level}-{first:0{_WIDTH}d}-{last:0{_WIDTH}d}"

    def _folder(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def _publish(self, spark: SparkSession, old: dict, folders: list, gone: list[str]) -> dict:
        new = {"step": old["step"] + 1, "folders": folders, "gone": gone}
        publish_text(spark, f"{self.path}/lists/{new['step']:0{_WIDTH}d}.json", json.dumps(new))
        for folder in old["gone"]:
            delete_path(spark, folder)
        for name in list_names(spark, f"{self.path}/lists"):
            if name.endswith(".json") and name < f"{old['step']:0{_WIDTH}d}":
                delete_path(spark, f"{self.path}/lists/{name}")
        return new

    def write(self, batch: DataFrame, batch_id: int, before_merge: Callable[[], None] | None = None) -> bool:
        """Add a micro-batch (it holds a key once); False if it is listed already. Then merge what is due.

        ``before_merge`` is called between a merge's writing and its publishing.
        """
        spark = batch.sparkSession
        state = self._list(spark)
        fresh = not any(first <= batch_id <= last for _, first, last, _, _ in state["folders"])
        if fresh:
            name = self._name(0, batch_id, batch_id)
            rows = batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
            rows.write.mode("overwrite").options(**PLAIN_FILES).parquet(self._folder(name))
            filled = not spark.read.schema(rows.schema).parquet(self._folder(name)).isEmpty()
            state = self._publish(spark, state, [*state["folders"], [0, batch_id, batch_id, name, filled]], [])
        for place, sources in self._merges(state["folders"]):
            holders = [f for f in sources if f[4]] or sources[:1]
            if len(holders) == 1:
                name, filled = holders[0][3:]
            else:
                name, filled = self._name(*place), True
                found = spark.read.parquet(*[self._folder(f[3]) for f in holders])
                newest_of_each(found, self.keys).write.mode("overwrite").options(**PLAIN_FILES).parquet(self._folder(name))
            if before_merge is not None:
                before_merge()
            state = self._publish(spark, state, [f for f in state["folders"] if f not in sources] + [[*place, name, filled]],
                                  [self._folder(f[3]) for f in sources if f[3] != name])
        return fresh

    def _merges(self, folders: list) -> list[tuple[tuple, list]]:
        """What is due: (level, first batch, last batch) of each merged folder, and the listed folders it is made of."""
        made = {tuple(f[:3]): [f] for f in folders}
        while (due := self._due(list(made))) is not None:
            sources = [f for part in due for f in made.pop(part)]
            made[due[0][0] + 1, due[0][1], due[-1][2]] = sources
        return [(place, sources) for place, sources in made.items() if len(sources) > 1]

    def _due(self, folders: list) -> list | None:
        for level in sorted({f[0] for f in folders}):
            same = sorted((f for f in folders if f[0] == level), key=lambda f: f[1])
            if len(same) >= self.fan_in:
                return same[:self.fan_in]
        return None

    def folders(self, spark: SparkSession) -> list[str]:
        return [self._folder(f[3]) for f in self._list(spark)["folders"]]

    def latest(self, spark: SparkSession) -> DataFrame:
        """Per key its newest row."""
        found = self.folders(spark)
        if not found:
            raise FileNotFoundError(f"{self.path} holds no batch yet")
        return newest_of_each(spark.read.parquet(*found), self.keys).drop("_batch")
