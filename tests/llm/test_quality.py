import os
import zlib

import numpy as np
import pytest

from helpers import AWKWARD, docs, prose
from tickwise.llm import quality as op

SF = "/root/testdata/sf0.1"
LABEL = "doc_id bigint, quality int, toxic int"


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 4 == 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
def test_held_out_accuracy(spark):
    table, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {x.doc_id: x for x in op.classify(table, labels).collect()}
    test = [(got[x.doc_id], x.quality) for x in labels.collect() if held(x.doc_id)]
    assert len(got) == table.count() and len(test) > 500
    assert np.mean([x.predicted == y for x, y in test]) > 0.97
    assert np.mean([x.predicted for x, y in test if y == 1]) > 0.99
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) and x.held_out == held(d) for d, x in got.items())


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    rows = [(d, prose(60, d) if d % 3 else "spam " * 60) for d in range(200)]
    labels = [(d, int(d % 3 > 0), 0) for d in range(0, 200, 2)]
    one = op.classify(docs(spark, rows), spark.createDataFrame(labels, LABEL))
    other = [(d, 1 - q if held(d) else q, 1) for d, q, _ in labels]
    two = op.classify(docs(spark, [(*r, "xx") for r in rows], extra=True).drop("source", "n_chars"),
                      spark.createDataFrame(other, LABEL))
    score = lambda df: {x.doc_id: x.score for x in df.collect()}
    assert score(one) == pytest.approx(score(two))
    assert np.mean([(score(one)[d] >= 0.7) == (d % 3 > 0) for d, _ in rows]) > 0.97


@pytest.mark.parametrize("labels,expected", [([], 0.5), ([(8, 1, 0), (7, 1, 0)], 1.0), ([(8, 0, 0)], 0.0),
                                             ([(None, 1, 0), (8, None, 0), (999, 1, 0)], 0.5)])
def test_awkward_rows_and_labels(spark, labels, expected):
    got = op.classify(docs(spark, AWKWARD, extra=True), spark.createDataFrame(labels, LABEL)).collect()
    assert len(got) == len(AWKWARD) and {x.score for x in got} == {expected}
    assert op.classify(docs(spark, []), spark.createDataFrame(labels, LABEL)).collect() == []


def test_isotonic_pools_violators():
    knots, levels = op.isotonic(np.array([0.0, 1.0, 2.0, 3.0]), np.ones(4), np.array([0.2, 0.8, 0.4, 0.9]))
    assert list(np.interp([0, 1, 2, 3], knots, levels)) == pytest.approx([0.2, 0.6, 0.6, 0.9])


def test_normal_equations_of_partitions_add_up(spark):
    rows = [(d, prose(20 + d % 50, d) if d % 2 else "bad " * (20 + d % 50)) for d in range(400)]
    labels = spark.createDataFrame([(d, d % 2, 0) for d in range(400)], LABEL)
    betas = []
    for parts in (1, 7):
        table = op.statistics_table(docs(spark, rows).repartition(parts))
        betas.append(op.fit(table, labels).beta)
    assert betas[0] == pytest.approx(betas[1], rel=1e-4, abs=1e-6)


def test_fit_is_the_direct_solution(spark):
    """The model against one dense ridge solve and one pooling over all learning rows at once."""
    rows = [(d, prose(20 + d % 50, d) if d % 3 else "bad, Bad " * (10 + d % 40)) for d in range(500)]
    quality = {d: int(d % 3 > 0) if d % 17 else 0 for d in range(500)}
    table = op.statistics_table(docs(spark, rows).repartition(4))
    model = op.fit(table, spark.createDataFrame([(d, q, 0) for d, q in quality.items()], LABEL))

    fold = {d: zlib.crc32(str(d).encode()) % 4 for d in quality}
    x = {d: np.array(op.statistics(t)) for d, t in rows}
    learned = [d for d in quality if fold[d] != 2]
    every = np.array([x[d] for d in learned])
    assert model.mean == pytest.approx(every.mean(axis=0)) and model.scale[every.std(axis=0) > 1e-6] == pytest.approx(
        every.std(axis=0)[every.std(axis=0) > 1e-6])
    ridge = [d for d in learned if fold[d] != 3]
    phi = model.expand(np.array([x[d] for d in ridge]))
    penalty = np.sqrt(op.RIDGE * len(ridge) / op.FEATURES) * np.eye(phi.shape[1])
    beta = np.linalg.lstsq(np.vstack([phi, penalty]), np.concatenate([[quality[d] for d in ridge], np.zeros(phi.shape[1])]),
                           rcond=None)[0]
    later = [d for d in learned if fold[d] == 3]
    raw = model.expand(np.array([x[d] for d in later])) @ beta
    assert model.raw(np.array([x[d] for d in later])) == pytest.approx(raw, abs=1e-5)
    cells = {}
    for s, d in zip(model.raw(np.array([x[d] for d in later])), later):
        cells.setdefault(np.floor((min(max(s, -0.5), 1.5) + 0.5) * op.BINS / 2), []).append((s, quality[d]))
    points = np.array([(np.mean([s for s, _ in c]), len(c), np.mean([y for _, y in c])) for _, c in sorted(cells.items())])
    # The rising line of least squares, by the minimax formula over all runs of points.
    w, m = points[:, 1], points[:, 2]
    mean = lambda i, j: (w[i:j + 1] * m[i:j + 1]).sum() / w[i:j + 1].sum()
    line = [max(min(mean(i, j) for j in range(k, len(m))) for i in range(k + 1)) for k in range(len(m))]
    assert np.interp(points[:, 0], model.knots, model.levels) == pytest.approx(line, abs=1e-9)
