"""A dimension that changes while a stream runs: every micro-batch is joined to one checked version of it.

The source (the metadata file) is looked at when a micro-batch is about to be joined. If its content changed, the new
rows are checked and copied to a version folder, and from this batch on that version holds. Which batch saw which
version is recorded before the batch is joined, so a batch that runs again after a crash, even long after, sees
the version it saw first, whatever the file has become.

A version counts only when it is whole: it is written under a temporary name, renamed, and its name holds the
rows' number and hash, which are compared whenever a process first reads it. Content that cannot be a version is
refused and the old one kept: keys that occur twice, and a file that is gone after there was one (before that, a
missing file is an empty dimension). ``refused`` tells the reasons of this process, by batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tickwise.operators.enrich import enrich
from tickwise.operators.joins import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, check_size
from tickwise.sources.files import read_metadata
from tickwise.sources.fs import delete_path, list_names, path_exists, publish_text, read_text
from tickwise.sources.versions import content_mark, read_version, stored_version
from tickwise.streaming.heavy import HeavyHitters

_WIDTH = 20


class VersionedDimension:
    """Versions of the dimension that ``path`` holds, kept below ``folder`` (beside the query's checkpoint)."""

    def __init__(self, path: str, folder: str, key: str = "symbol", columns: Sequence[str] = ("coin_name", "category"),
                 read: Callable[[SparkSession, str], DataFrame] = read_metadata, max_rows: int = DEFAULT_MAX_ROWS,
                 max_bytes: int = DEFAULT_MAX_BYTES):
        self.path, self.folder, self.key, self.columns, self.source = path, folder.rstrip("/"), key, tuple(columns), read
        self.max_rows, self.max_bytes = max_rows, max_bytes
        self.refused: list[tuple[int, str]] = []
        self._known: dict[str, tuple[DataFrame, bool]] = {}

    # The state is one record: the last batch that was resolved, and the batches from which a new version held.
    def _state(self, spark: SparkSession) -> dict:
        names = [n for n in list_names(spark, f"{self.folder}/batches") if n.endswith(".json")]
        return json.loads(read_text(spark, f"{self.folder}/batches/{max(names)}")) if names else {"last": -1, "from": []}

    def _record(self, spark: SparkSession, state: dict) -> None:
        name = f"{state['last']:0{_WIDTH}d}.json"
        publish_text(spark, f"{self.folder}/batches/{name}", json.dumps(state))
        for old in list_names(spark, f"{self.folder}/batches"):
            if old.endswith(".json") and old < name:
                delete_path(spark, f"{self.folder}/batches/{old}")

    def history(self, spark: SparkSession) -> list[tuple[int, str]]:
        """(first batch, version mark), oldest first."""
        return [tuple(x) for x in self._state(spark)["from"]]

    def _newest(self, spark: SparkSession, batch_id: int, current: str | None) -> str:
        """The mark of the version that holds from now on."""
        try:
            if current is not None and not path_exists(spark, self.path):
                raise ValueError(f"{self.path} is gone")
            rows = self.source(spark, self.path).select(self.key, *self.columns)
            mark = content_mark(rows)
            if mark == current or path_exists(spark, f"{self.folder}/version={mark}"):
                return mark
            return stored_version(spark, rows, self.folder, self.key)
        except Exception as error:  # noqa: BLE001 - whatever ails the new content, the version there is goes on
            if current is None:
                raise
            self.refused.append((batch_id, str(error).split("\n")[0]))
            return current

    def resolve(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, bool]:
        """(rows, whether their checked size allows a broadcast) of the version that a micro-batch is joined to."""
        state = self._state(spark)
        if batch_id > state["last"]:
            current = state["from"][-1][1] if state["from"] else None
            mark = self._newest(spark, batch_id, current)
            if mark != current:
                state["from"].append([batch_id, mark])
            self._record(spark, {"last": batch_id, "from": state["from"]})
        else:
            mark = [m for first, m in state["from"] if first <= batch_id][-1]
        if mark not in self._known:
            rows = read_version(spark, self.folder, mark)
            self._known[mark] = rows, check_size(rows, self.max_rows, self.max_bytes).bounded
        return self._known[mark]

    def joined(self, write: Callable[[DataFrame, int], bool | None],
               heavy: HeavyHitters | None = None) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function: the batch left-joined to its version, then handed to ``write``.

        A version too large for a broadcast is joined by a shuffle, with the hot keys that ``heavy`` names dealt
        over many tasks; without it they are counted in the batch itself.
        """
        def run(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            rows, small = self.resolve(spark, batch_id)
            if heavy is None or small:
                write(enrich(batch, rows, key=self.key, columns=self.columns, broadcast=small), batch_id)
                return
            watched, seen = heavy.observed(batch)
            done = write(enrich(watched, rows, key=self.key, columns=self.columns, broadcast=False,
                                heavy=heavy.keys(spark, batch_id)), batch_id)
            if not batch.isEmpty():
                # A batch that its writer found stored already was not evaluated and so not observed.
                heavy.record(spark, batch_id, dict(batch.dtypes)[heavy.key],
                             heavy.sketched(batch) if done is False else seen.get)

        return run
