"""Micro-batch writers for ``foreachBatch`` and readers of what they wrote.

``append_writer`` keeps the flat folder contract of the original storage job (Parquet files directly in the
table folder) and is at-least-once: a micro-batch replayed after a crash between write and commit is
written twice. ``flat_log.FlatLog`` keeps the same folder without duplicates. ``versioned_writer`` is exactly-once in effect: every micro-batch overwrites its own
``batch_id=N`` folder, so a replay replaces rather than duplicates. Spark's own file sink (see
``queries.raw_storage_query``) is the exactly-once choice for append-only output.

Neither writer coalesces: every task writes its own file, so a large micro-batch is written in parallel.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tickwise.functions.parse import accepted, rejected
from tickwise.sources.fs import delete_path, files_below, move
from tickwise.streaming.flat_log import PLAIN_FILES

BatchWriter = Callable[[DataFrame, int], None]


def append_writer(path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> BatchWriter:
    """Append every non-empty micro-batch to ``path``; empty batches write nothing.

    A batch is written to a folder beside the table and its files are then moved in, so no marker and no checksum
    file ever lies in the table folder, whatever the session's settings, and only the batch's own files are listed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, stage = batch.sparkSession, f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
        try:
            writer = batch.write.format(fmt).options(**PLAIN_FILES)
            (writer.partitionBy(*partition_by) if partition_by else writer).save(stage)
            names = files_below(spark, stage)
            if fmt == "parquet" and len(names) == 1 and spark.read.schema(batch.schema).parquet(stage).isEmpty():
                return  # an empty batch may leave one file that tells the schema alone
            for name in names:  # Spark's file names hold the write's own id and never meet another batch's
                move(spark, f"{stage}/{name}", f"{path.rstrip('/')}/{name}")
        finally:
            delete_path(spark, stage)

    return write


def versioned_writer(path: str, fmt: str = "parquet") -> BatchWriter:
    """Write each micro-batch to ``path/batch_id=N``, replacing that folder if the batch is replayed.

    One folder per micro-batch suits bounded runs and audits; for a query that runs for months
    :class:`~tickwise.streaming.tiers.TieredLog` keeps the number of folders small.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str], schema=None,
                   fmt: str = "parquet") -> DataFrame:
    """Collapse an update-mode log written by :func:`versioned_writer`: per key, the row of the highest
    micro-batch (a batch holds a key once). A partial hash aggregation over values of fixed width, so a
    frequently updated key costs one row per task and the log is not sorted."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    log = reader.load(path)
    values = [c for c in log.columns if c not in keys and c != "batch_id"]
    return log.groupBy(*keys).agg(*[F.max_by(F.col(c), F.col("batch_id")).alias(c) for c in values])


def fan_out(*branches: tuple[Callable[[DataFrame], DataFrame], BatchWriter]) -> BatchWriter:
    """One writer for several outputs of a micro-batch, each (selection, writer).

    The batch is kept while they are written, so its source and parsing run once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for select, to in branches:
                to(select(held), batch_id)
        finally:
            held.unpersist()

    return write


def split_writer(write_ticks: BatchWriter, write_rejects: BatchWriter, keep: Sequence[str] = ()) -> BatchWriter:
    """For a stream of :func:`~tickwise.functions.parse.split_messages`: ticks to one writer, rejects to the other."""
    return fan_out((accepted, write_ticks), (lambda split: rejected(split, keep), write_rejects))
