"""Exactly-once storage in a flat folder of Parquet files, with a commit log beside it.

The table folder holds data files and nothing else, so any Parquet reader can use it, yet a micro-batch that runs
again after a crash is stored once. A batch goes through four steps, each of which a replay finds and resumes:

1. *staged*: its files are written to a folder of their own; a replay that finds no more than this starts anew;
2. *prepared*: one record names them and their final places; from here on the batch is never computed again;
3. *published*: every file is renamed into the table folder, under a name made of log, batch and number;
4. *committed*: the record moves to the committed ones, with the batch's zone rows (see below).

A published file is final: a replay moves what is still staged and nothing else, so a stream over the table folder
(Spark's file source) sees each row once too. No step lists the table folder; the log keeps a cumulative record
every ``compact_every`` batches and drops the older ones, so it has a bounded number of entries. The log belongs to
the query's checkpoint: keep it there, and give every query its own.

*Zones*: for every file and key its rows and its first and last event time, taken from the staged files. Counts,
time ranges and rows per key are sums over that small table, and the newest rows are looked for only in files that
can hold them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.summary import newest
from tickwise.sources.fs import delete_path, files_below, list_names, move, publish_text, read_text

#: Written as options of every write, so that no marker or summary file appears whatever the session's settings.
PLAIN_FILES = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false", "parquet.summary.metadata.level": "NONE"}
_WIDTH = 12


@dataclass(frozen=True)
class FlatLog:
    """The commit log at ``path`` of the table folder ``table``."""

    table: str
    path: str
    key: str | None = "symbol"
    timestamp: str = "timestamp"
    compact_every: int = 20

    # -- records ---------------------------------------------------------------------------------------------

    def _record(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/{batch_id:0{_WIDTH}d}.json"

    def _name(self, spark: SparkSession) -> str:
        """A name of this log, part of every file name: a new log never meets the files of an older one."""
        publish_text(spark, f"{self.path}/name", uuid.uuid4().hex[:12])
        return read_text(spark, f"{self.path}/name")

    def _committed(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        """(batch of the newest cumulative record, later committed batches)."""
        names = list_names(spark, f"{self.path}/committed")
        whole = [int(n[:_WIDTH]) for n in names if n.endswith(".all.json")]
        last = max(whole, default=None)
        single = sorted(int(n[:_WIDTH]) for n in names if n.endswith(".json") and not n.endswith(".all.json"))
        return last, [b for b in single if last is None or b > last]

    def is_committed(self, spark: SparkSession, batch_id: int) -> bool:
        last, later = self._committed(spark)
        return batch_id in later or (last is not None and batch_id <= last)

    def files(self, spark: SparkSession) -> list[str]:
        """Names, below the table folder, of all committed files: one name per file, read from the log."""
        last, later = self._committed(spark)
        found = json.loads(read_text(spark, f"{self.path}/committed/{last:0{_WIDTH}d}.all.json")) if last is not None else []
        for batch_id in later:
            found += json.loads(read_text(spark, self._record("committed", batch_id)))
        return found

    # -- writing ---------------------------------------------------------------------------------------------

    def write(self, batch: DataFrame, batch_id: int, partition_by: Sequence[str] = (),
              before_commit: Callable[[int], None] | None = None) -> bool:
        """Store a micro-batch once, however often it is written; an empty one stores no file.

        False if the batch was not evaluated, because an earlier run had stored or prepared it.
        ``before_commit`` is called when the files are published and the batch is not yet committed.
        """
        spark = batch.sparkSession
        if self.is_committed(spark, batch_id):
            return False
        record, stage = self._record("prepared", batch_id), f"{self.path}/staged/{batch_id:0{_WIDTH}d}"
        prepared = read_text(spark, record)
        fresh = prepared is None
        if fresh:
            delete_path(spark, stage)
            writer = batch.write.mode("overwrite").options(**PLAIN_FILES)
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(stage)
            prefix = f"part-{self._name(spark)}-{batch_id:0{_WIDTH}d}"
            names, moves = files_below(spark, stage), []
            if len(names) == 1 and spark.read.schema(batch.schema).parquet(stage).isEmpty():
                names = []  # an empty batch may leave one file that tells the schema alone
            for k, staged in enumerate(names):
                folder = staged.rpartition("/")[0]
                moves.append([staged, f"{folder}/{prefix}-{k:05d}.parquet".lstrip("/")])
            # Zones name the final files; the order of staged names decides the numbers, so both can be told.
            self._write_zones(spark, batch, stage, dict(moves), batch_id)
            prepared = json.dumps(moves)
            publish_text(spark, record, prepared)
        moves = json.loads(prepared)
        left = set(files_below(spark, stage))
        for staged, final in moves:
            if staged in left:
                move(spark, f"{stage}/{staged}", f"{self.table.rstrip('/')}/{final}")
        if before_commit is not None:
            before_commit(batch_id)
        publish_text(spark, self._record("committed", batch_id), json.dumps([final for _, final in moves]))
        delete_path(spark, record)
        delete_path(spark, stage)
        self._compact(spark)
        return fresh

    def writer(self, partition_by: Sequence[str] = (), before_commit: Callable[[int], None] | None = None):
        """The function for ``foreachBatch``."""
        return lambda batch, batch_id: self.write(batch, batch_id, partition_by, before_commit)

    def _compact(self, spark: SparkSession) -> None:
        last, later = self._committed(spark)
        if len(later) < self.compact_every:
            return
        upto = later[-1]
        if self.key is not None:  # a zone folder counts once its record is there
            self._zone_rows(spark, last, later).write.mode("overwrite").options(**PLAIN_FILES).parquet(
                f"{self.path}/zones/upto={upto:0{_WIDTH}d}")
        whole = f"{upto:0{_WIDTH}d}.all.json"
        publish_text(spark, f"{self.path}/committed/{whole}", json.dumps(self.files(spark)))
        for name in list_names(spark, f"{self.path}/committed"):
            if name != whole and name[:_WIDTH].isdigit() and int(name[:_WIDTH]) <= upto:
                delete_path(spark, f"{self.path}/committed/{name}")
        for name in list_names(spark, f"{self.path}/zones"):
            if name != f"upto={upto:0{_WIDTH}d}" and int(name[-_WIDTH:]) <= upto:
                delete_path(spark, f"{self.path}/zones/{name}")

    # -- zones -----------------------------------------------------------------------------------------------

    def _write_zones(self, spark: SparkSession, batch: DataFrame, stage: str, final: dict[str, str], batch_id: int) -> None:
        if self.key is None:
            return
        zones = f"{self.path}/zones/batch={batch_id:0{_WIDTH}d}"
        if not final:
            delete_path(spark, zones)
            return
        # The names of this batch's files only, a row per task and partition folder.
        names = spark.createDataFrame(list(final.items()), "name string, file string")
        parts = next(iter(final)).count("/") + 1
        uri = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
        name = F.array_join(F.slice(F.split(uri, "/"), -parts, parts), "/")
        staged = spark.read.schema(batch.schema).parquet(stage).select(self.key, self.timestamp, name.alias("name"))
        (staged.groupBy("name", self.key).agg(F.count(F.lit(1)).alias("rows"), F.count(self.timestamp).alias("timed"),
                                              F.min(self.timestamp).alias("first_time"),
                                              F.max(self.timestamp).alias("last_time"))
         .join(F.broadcast(names), "name").select("file", F.col(self.key).alias("key"), "rows", "timed", "first_time", "last_time")
         .write.mode("overwrite").options(**PLAIN_FILES).parquet(zones))

    def _zone_rows(self, spark: SparkSession, last: int | None, later: list[int]) -> DataFrame:
        folders = [f"{self.path}/zones/batch={b:0{_WIDTH}d}" for b in later]
        folders += [f"{self.path}/zones/upto={last:0{_WIDTH}d}"] if last is not None else []
        found = [f for f in folders if files_below(spark, f)]
        if not found:
            return spark.createDataFrame([], "file string, key string, rows bigint, timed bigint, "
                                              "first_time timestamp, last_time timestamp")
        return spark.read.parquet(*found)

    def zones(self, spark: SparkSession) -> DataFrame:
        """file, key, rows, timed (rows with an event time), first_time, last_time of all committed files."""
        return self._zone_rows(spark, *self._committed(spark))

    # -- reading ---------------------------------------------------------------------------------------------

    def _read(self, spark: SparkSession, schema: T.StructType, names: Sequence[str]) -> DataFrame:
        if not names:
            return spark.createDataFrame([], schema)
        root = self.table.rstrip("/")
        return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{n}" for n in names])

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The rows of all committed batches, found through the log."""
        return self._read(spark, schema, self.files(spark))

    def totals(self, spark: SparkSession) -> DataFrame:
        """record_count, first_event_timestamp, latest_event_timestamp, from the zones: no data file is opened."""
        return self.zones(spark).agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("record_count"),
                                     F.min("first_time").alias("first_event_timestamp"),
                                     F.max("last_time").alias("latest_event_timestamp"))

    def rows_by_key(self, spark: SparkSession) -> DataFrame:
        """key, count from the zones: no data file is opened."""
        return self.zones(spark).groupBy(F.col("key").alias(self.key or "key")).agg(F.sum("rows").cast("bigint").alias("count"))

    def newest(self, spark: SparkSession, schema: T.StructType, n: int, order: Sequence[str] | None = None) -> DataFrame:
        """The ``n`` newest rows by ``order`` (event time first). Only files that can hold one of them are opened.

        Files by falling first time: when those so far hold ``n`` rows, any other file whose last time lies before
        the least first time of them holds none of the newest.
        """
        order = list(order or [self.timestamp])
        each = self.zones(spark).groupBy("file").agg(F.sum("timed").alias("timed"), F.min("first_time").alias("first_time"),
                                                     F.max("last_time").alias("last_time"))
        files = each.where(F.col("last_time").isNotNull()).orderBy(F.desc("first_time")).collect()  # a row per file
        held, edge = 0, None
        for r in files:
            held += r["timed"]
            if held >= n:
                edge = r["first_time"]
                break
        chosen = [r["file"] for r in files if edge is None or r["last_time"] >= edge]
        if held < n:  # rows without an event time come last of all
            chosen = [r["file"] for r in each.select("file").collect()]
        return newest(self._read(spark, schema, chosen), n, order)

