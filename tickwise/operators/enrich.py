"""Left-outer enrichment of ticks with a static dimension.

Unmatched ticks keep null descriptive columns. Existing descriptive columns on the ticks are replaced. The
same call serves a streaming and a batch left side: a stream-static left join is stateless in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickwise.operators.joins import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, assert_unique_keys, lookup_join


def enrich(ticks: DataFrame, dimension: DataFrame, key: str = "symbol",
           columns: Sequence[str] = ("coin_name", "category"), broadcast: bool | None = None,
           check_unique: bool = False, max_rows: int = DEFAULT_MAX_ROWS,
           max_bytes: int = DEFAULT_MAX_BYTES, heavy: Sequence[tuple] | None = None) -> DataFrame:
    """Left join ``ticks`` to ``dimension`` on ``key`` and add ``columns``.

    Output order: key, descriptive columns, then the remaining tick columns. An empty dimension leaves the
    ticks' values as they are except that the descriptive columns become null. ``check_unique`` runs a
    guard job first: duplicate dimension keys would multiply ticks and inflate every count downstream. ``heavy``:
    hot keys that are known already, for a dimension too large to broadcast.
    """
    columns = list(columns)
    dim = dimension.select(key, *columns)
    if check_unique:
        assert_unique_keys(dim, key)
    base = ticks.drop(*[c for c in columns if c in ticks.columns])
    joined = lookup_join(base, dim, key, "left", broadcast=broadcast, max_rows=max_rows,
                         max_bytes=max_bytes, heavy=heavy)
    rest = [c for c in base.columns if c != key]
    return joined.select(key, *columns, *rest)
