"""Every registered query against its DuckDB oracle on the smallest shared tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tickwise.config import release_scratch, scratch_root
from tickwise.plans import registered
from tickwise.streaming import registered as streaming
from tickwise.streaming import registered_durable as durable

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "events"]
QUERIES = {**registered.QUERIES, **streaming.QUERIES, **durable.QUERIES}
ORACLES = {**registered.ORACLE_SQL, **streaming.ORACLE_SQL, **durable.ORACLE_SQL}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(round(v, 9)))
    return (1, str(v))


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "symbol", "coin_name", "category",
                          "average_price", "max_price", "min_price", "event_count"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(got, df.columns) == _rows(exp, cols)


def test_scratch_is_empty_once_released(spark):
    for name in ("inspection_row_count", "compacted_table", "dense_trend_grid", "stream_raw_store"):
        QUERIES[name](spark, SF).count()
    release_scratch(spark)
    assert not os.path.exists(scratch_root(spark).removeprefix("file:"))
    assert QUERIES["inspection_row_count"](spark, SF).first()["record_count"] > 0
