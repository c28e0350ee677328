"""Whitening against numpy over the distinct vectors; exact parts against Python's integers."""

import math
import random

import numpy as np
import pytest

from tickwise.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>"


def scaled(vector):
    return [math.floor(64 * c) + 1_000_000 for c in vector]


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def reference(rows, dims):
    """n, exact deviation per row, covariance and centred vectors of the rows that remain."""
    kept = [(i, scaled([float(np.float32(c)) for c in v])) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in kept]
    mean = np.array([s / n for s in sums])
    off = np.array(fit, float) - mean
    return n, deviation, off.T @ off / n, [(i, np.array(x, float) - mean) for i, x in kept]


def compare(df, rows, dims, components):
    n, deviation, covariance, centred = reference(rows, dims)
    found = df.collect()
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    by_row = {}
    for r in found:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(covariance), rel=1e-9)
    assert sorted({(str(k[0]), k[1]) for k in by_row}) == sorted({(str(i), d) for i, d in deviation})
    assert len(found) == len(centred) * components
    if len({i for i, _ in centred}) == len(centred):
        for k in range(components):
            want = np.array([x @ axes[:, k] / math.sqrt(values[k]) for _, x in centred])
            got = np.array([by_row[i, dict(deviation)[i]][k + 1][0] for i, _ in centred])
            assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7


def random_rows(n, dims, seed, spread=0.4):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread * (d + 1) / dims) for d in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("high", [1, 7, 50, 1 << 20, 1 << 40, 1 << 62])
def test_planes_give_exact_cross_products(high):
    y = np.random.default_rng(high % 97).integers(0, high + 1, (130, 7))
    y[:, 3] = 0
    bits = [int(v).bit_length() for v in y.max(axis=0)]
    cross, sums = W.cross_products(y, bits)
    whole = y.astype(object).T @ y.astype(object)
    assert all(int(cross[i, j]) == whole[i, j] for i in range(7) for j in range(i, 7))
    assert [int(s) for s in sums] == y.astype(object).sum(axis=0).tolist()


def test_packing_round_trip():
    q = np.array([[0, 0], [127, -128], [128, 0], [-129, 5], [40_000, 1], [1 << 40, -1], [1 << 62, -(1 << 62)]], np.int64)
    packed = W.pack(q)
    assert [len(p) for p in packed] == [2, 2, 4, 4, 8, 16, 16]
    assert (W.unpack(packed, 2) == q).all()


def test_limbs_hold_any_sum():
    for value in (0, 1, (1 << 45) - 1, 1 << 126, (1 << 160) - 7):
        assert sum(v << (45 * k) for k, v in enumerate(W._limbs(value))) == value


def test_whitened_rows(spark):
    rows = random_rows(700, 24, 1)
    compare(W.components_of(table(spark, rows).repartition(5)), rows, 24, 16)


def test_fewer_dimensions_than_components(spark):
    rows = random_rows(300, 5, 2)
    compare(W.components_of(table(spark, rows)), rows, 5, 5)


def test_repeated_and_unsound_vectors(spark):
    rows = random_rows(120, 6, 3)
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    rows += [(2000, None), (2001, []), (2002, [0.1, None, 0.2, 0.1, 0.1, 0.1]), (2003, [0.1] * 5), (2004, [0.2] * 7),
             (2005, [float("nan")] + [0.1] * 5), (2006, [0.1] * 5 + [float("-inf")]), (None, rows[1][1])]
    df = table(spark, rows)
    for name in ("x", "component", "n", "place", "whitened", "deviation", "dim", "i", "label"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    compare(W.components_of(df), rows, 6, 6)


def test_wide_entries(spark):
    rows = [(i, [v * 1e9, w, 3e5 * v]) for i, (_, (v, w)) in enumerate(random_rows(90, 2, 4))]
    double = "vec_id bigint, embedding array<double>"
    n, deviation, covariance, _ = reference([(i, v) for i, v in rows], 3)
    got = W.components_of(table(spark, [(i, [float(np.float32(c)) for c in v]) for i, v in rows], double))
    assert {(r["vec_id"], r["deviation"]) for r in got.collect()} == {
        (i, d if d < 1 << 63 else None) for i, d in deviation}
    huge = W.components_of(table(spark, [(i, [1e30 * (-1) ** i, float(i)]) for i in range(8)], double)).collect()
    assert huge and all(r["deviation"] is None and r["identity_error"] < 1e-4 for r in huge)


def test_dependent_dimensions_have_no_component(spark):
    rows = [(i, [v[0], v[1], v[0], 0.25]) for i, v in random_rows(200, 2, 5)]
    compare(W.components_of(table(spark, rows)), rows, 4, 2)


def test_tables_without_variance(spark):
    assert W.components_of(table(spark, [])).collect() == []
    assert W.components_of(table(spark, [(1, None), (2, [])])).collect() == []
    assert W.components_of(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect() == []
