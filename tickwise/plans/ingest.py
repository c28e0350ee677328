"""The producer's data path on Spark: API snapshots -> ticks -> Kafka records.

Polling an HTTP endpoint is single-machine I/O and stays outside Spark; its responses, collected as a
table ``(status, body, fetched_at)``, are shaped here. Bodies are parsed once into a written quote table, from
which ticks, records (keyed by symbol, prices as quoted) and rejects are told apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.config import Settings, written
from tickwise.functions.encode import kafka_records
from tickwise.functions.snapshot import DEFAULT_ASSETS, Assets, rejects_of, snapshot_split, ticks_of
from tickwise.operators.joins import row_hash
from tickwise.sources import kafka


@dataclass
class IngestResult:
    ticks: DataFrame
    records: DataFrame
    rejects: DataFrame


def with_fetch_time(snapshots: DataFrame, column: str = "fetched_at") -> DataFrame:
    """Stamp snapshots without a recorded fetch time with the current time (one instant per query)."""
    if column in snapshots.columns:
        return snapshots
    return snapshots.withColumn(column, F.current_timestamp())


def cap_events(ticks: DataFrame, max_events: int = 0, order: tuple[str, ...] = ("timestamp", "symbol")) -> DataFrame:
    """Exactly the first ``max_events`` ticks by ``order``, ties by a row hash; 0 means unlimited.

    One path for every size. Rows are counted per hour of the first order column (a small aggregation); hours
    before the one in which the cap falls are kept by a pushed-down filter, later ones are never read, and only
    the rows of that one hour are ordered: they are range-partitioned by order and row hash, counted per
    partition, and cut inside the partition where the cap falls. Equal rows beyond the cut are interchangeable.
    """
    if max_events <= 0:
        return ticks
    time = order[0]
    kind = dict(ticks.dtypes)[time]
    if kind in ("timestamp", "timestamp_ntz"):
        hour = F.date_trunc("hour", F.col(time)).cast(kind)
        sizes = ticks.groupBy(hour.alias("h")).count()
        # One row per hour of data; the running total over them is the only global order.
        rows = sizes.orderBy(F.col("h").asc_nulls_first()).select(F.col("h").cast("string").alias("h"), "count").collect()
        total, edge = 0, None
        for k, r in enumerate(rows):
            if total + r["count"] > max_events:
                edge = k
                break
            total += r["count"]
        if edge is None:
            return ticks
        at = rows[edge]["h"]
        if at is None:
            before, inside = ticks.where(F.lit(False)), ticks.where(F.col(time).isNull())
        else:
            start = F.lit(at).cast(kind)
            end = (start + F.expr("INTERVAL 1 HOUR")).cast(kind)
            before = ticks.where(F.col(time).isNull() | (F.col(time) < start))
            inside = ticks.where((F.col(time) >= start) & (F.col(time) < end))
        return before.unionByName(_first_rows(inside, max_events - total, order))
    return _first_rows(ticks, max_events, order)


def _first_rows(df: DataFrame, n: int, order: tuple[str, ...]) -> DataFrame:
    """The first ``n`` rows by ``order`` then row hash; partitions and row numbers are fixed by writing them."""
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # row number in partition
    ranked = written(df.withColumn("_tie", row_hash(df))
                     .repartitionByRange(*[F.col(c) for c in order], F.col("_tie"))
                     .sortWithinPartitions(*order, "_tie")
                     .withColumn("_pid", F.spark_partition_id()).withColumn("_pos", within), "first_rows")
    kept, total, cut = [], 0, None
    for pid, size in sorted((r["_pid"], r["count"]) for r in ranked.groupBy("_pid").count().collect()):
        if total + size > n:
            cut = (pid, n - total)
            break
        total += size
        kept.append(pid)
    chosen = F.col("_pid") < (cut[0] if cut else (kept[-1] + 1 if kept else 0))
    if cut:
        chosen = chosen | ((F.col("_pid") == cut[0]) & (F.col("_pos") < cut[1]))
    return ranked.where(chosen).select(*df.columns)


def shape(snapshots: DataFrame, assets: Assets = DEFAULT_ASSETS, max_events: int = 0,
          keep: tuple[str, ...] = ()) -> IngestResult:
    split = written(snapshot_split(with_fetch_time(snapshots), assets, keep=keep), "quotes")
    ticks = cap_events(ticks_of(split, keep), max_events)
    return IngestResult(ticks.drop("price_text"), kafka_records(ticks, price="price_text", keep=keep, exact=True),
                        rejects_of(split, keep=keep))


def publish(result: IngestResult, settings: Settings) -> None:
    """Write the records to the topic (needs the Kafka connector on the classpath)."""
    kafka.write_records(result.records, settings)
