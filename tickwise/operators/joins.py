"""Joins of a large fact side against a lookup side of unknown size.

The lookup side is broadcast only after Spark jobs have proven it small: a distributed row count, and only
when that is within bounds a byte count over those few rows. Otherwise the fact side is split by key. A
counting pass over the key columns alone finds the keys that hold more than a given share of all facts; there
can be at most ``1 / share`` of them, so their lookup rows are few by construction and are broadcast, while all
other facts take a sort-merge join. No lookup row is replicated and no fact column is read that is not needed.

Where the hot keys are known beforehand, as on a stream that carries a sketch of them, the facts are joined in one
pass: the facts of those keys are salted over many tasks and only their few lookup rows are repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.config import written

DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
#: Share of all facts from which a key is joined apart: at most 1 / share keys are.
HEAVY_SHARE = 0.005


@dataclass(frozen=True)
class SizeCheck:
    rows: int
    bytes: int
    bounded: bool


def row_bytes(df: DataFrame):
    """Approximate in-memory bytes of a row: string/binary lengths plus 16 per other column."""
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:
            parts.append(F.lit(16))
    return sum(parts[1:], parts[0]) if parts else F.lit(0)


def row_hash(df: DataFrame):
    """A deterministic hash of a row's content (map columns, which Spark cannot hash, are left out)."""
    cols = [F.col(c) for c, t in df.dtypes if not t.startswith("map")]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("long")


def check_size(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
               max_bytes: int = DEFAULT_MAX_BYTES) -> SizeCheck:
    """Probe a relation's size with distributed aggregations (no single-task funnel, nothing but two
    numbers reaches the driver).

    First the row count: a partial count per task (for Parquet files only row-group metadata is read).
    Only when it is within ``max_rows`` the bytes of those rows are summed (``bytes`` is -1 otherwise).
    """
    n = int(df.agg(F.count(F.lit(1))).first()[0])
    if n > max_rows:
        return SizeCheck(rows=n, bytes=-1, bounded=False)
    b = int(df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0])
    return SizeCheck(rows=n, bytes=b, bounded=b <= max_bytes)


def assert_unique_keys(df: DataFrame, keys: Sequence[str] | str) -> None:
    """Raise when a lookup relation holds a key more than once (a join would multiply facts)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        shown = {k: dup[0][k] for k in keys}
        raise ValueError(f"lookup keys are not unique, e.g. {shown} occurs {dup[0]['count']} times")


def heavy_keys(facts: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE) -> list[tuple]:
    """Keys that hold at least ``share`` of all facts: at most 1 / share of them, so they may reach the driver.

    The facts are evaluated once: the total is the sum of the written counts per key.
    """
    counts = written(facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key_counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    rows = counts.where((F.col("_n") >= F.lit(max(2, total * share)))
                        & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).select(*keys).collect()
    return [tuple(r) for r in rows]


def salted_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str, heavy: Sequence[tuple],
                salts: int | None = None) -> DataFrame:
    """Sort-merge join in which the facts of the ``heavy`` keys are dealt over ``salts`` tasks each.

    Facts with a null key match nothing and are spread too. Only the lookup rows of those keys are repeated. ``salts`` defaults to the session's shuffle partitions.
    """
    keys, spark = list(keys), facts.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*keys)
    hot = key.isin([F.struct(*[F.lit(v).cast(facts.schema[k].dataType) for k, v in zip(keys, row)]) for row in heavy]) \
        if heavy else F.lit(False)
    unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = F.when(unmatched | F.coalesce(hot, F.lit(False)), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0)
    copies = F.when(F.coalesce(hot, F.lit(False)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return (facts.withColumn("_salt", salt.cast("int"))
            .join(lookup.withColumn("_salt", F.explode(copies)).hint("merge"), [*keys, "_salt"], how).drop("_salt"))


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str] | str, how: str = "left",
                broadcast: bool | None = None, max_rows: int = DEFAULT_MAX_ROWS,
                max_bytes: int = DEFAULT_MAX_BYTES, heavy_share: float = HEAVY_SHARE,
                heavy: Sequence[tuple] | None = None) -> DataFrame:
    """Equi-join ``facts`` (preserved for ``how="left"``) with ``lookup`` on ``keys``.

    ``broadcast=None`` decides by a bounded size probe; ``True`` forces a broadcast (caller vouches for
    the bound), ``False`` forces the shuffle join. ``heavy`` names the hot keys if they are known already, as on a
    stream, whose facts cannot be counted beforehand (see ``streaming.heavy``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in ("left", "inner"):
        raise ValueError("lookup_join supports left and inner joins")
    if broadcast is None:
        broadcast = check_size(lookup, max_rows, max_bytes).bounded
    if broadcast:
        return facts.join(F.broadcast(lookup), keys, how)
    # Size not proven: pin a sort-merge join so no estimate can turn the lookup into a broadcast.
    if heavy is not None:
        return salted_join(facts, lookup, keys, how, heavy)
    heavy = [] if facts.isStreaming else heavy_keys(facts, keys, heavy_share)
    if not heavy:
        return facts.join(lookup.hint("merge"), keys, how)
    is_heavy = reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, key)]) for key in heavy])
    few = lookup.where(is_heavy)
    if not check_size(few, max_rows, max_bytes).bounded:  # a lookup that repeats a heavy key very often
        return facts.join(lookup.hint("merge"), keys, how)
    apart = facts.where(is_heavy).join(F.broadcast(few), keys, how)
    rest = facts.where(~is_heavy).join(lookup.where(~is_heavy).hint("merge"), keys, how)
    return apart.unionByName(rest)
