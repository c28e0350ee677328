import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import AWKWARD, docs, prose
from tickwise.llm import ngram_join as op
from tickwise.llm.graph import components


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width, num, den):
    """Component of every id; rows that share an id are one vertex."""
    sets = [(r[0], shingles(r[1], width)) for r in rows if r[0] is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y:
                shared = len(x & y)
                if den * shared >= num * (len(x) + len(y) - shared):
                    lo, hi = sorted((root(a), root(b)))
                    parent[hi] = lo
    return {d: root(d) for d, _ in sets}


def edited(words, k, r):
    out = list(words)
    for _ in range(k):
        out[r.randrange(len(out))] = f"new{r.randrange(10**6)}"
    return " ".join(out)


def corpus(seed, groups=12, copies=6, hot=60):
    """Near-copy families at every distance, a hot family, exact copies, and a passage most documents share."""
    r = random.Random(seed)
    passage = prose(30, 99)
    rows, d = [], 0
    for g in range(groups):
        base = [f"t{r.randrange(4000)}" for _ in range(r.choice([5, 9, 12, 40, 150, 400]))]
        for _ in range(copies):
            rows.append((d, edited(base, r.randrange(0, max(2, len(base) // 12)), r)))
            d += 1
    base = [f"h{r.randrange(3000)}" for _ in range(120)]
    for _ in range(hot):
        rows.append((d, edited(base, r.randrange(0, 7), r)))
        d += 1
    for _ in range(40):
        rows.append((d, " ".join(f"u{r.randrange(9000)}" for _ in range(r.randrange(3, 60))) + " " + passage))
        d += 1
    rows += [(d + i, rows[i * 5][1].upper()) for i in range(15)]
    return rows


@pytest.mark.parametrize("seed,width,num,den", [(1, 3, 90, 100), (2, 5, 80, 100), (3, 2, 70, 100)])
@pytest.mark.parametrize("heavy", [0, 200, 1 << 17])
def test_matches_brute_force(spark, monkeypatch, seed, width, num, den, heavy):
    monkeypatch.setattr(op, "HEAVY_LEAST", 3)
    rows = corpus(seed)
    got = op.similarity_classes(docs(spark, rows).repartition(3), width, num, den, heavy_tokens=heavy).collect()
    truth = brute(rows, width, num, den)
    assert {x.doc_id: x.component_id for x in got} == truth
    assert len(set(truth.values())) < len(rows) - 40
    texts = dict(rows)
    assert all(x.n_shingles == len(shingles(texts[x.doc_id], width)) for x in got)


@pytest.mark.parametrize("seed,width,num,den,slice_size", [(1, 3, 90, 100, 256), (2, 5, 80, 100, 3)])
def test_join_has_every_link(spark, monkeypatch, seed, width, num, den, slice_size):
    monkeypatch.setattr(op, "HEAVY_LEAST", 3)
    monkeypatch.setattr(op, "_SLICE", slice_size)
    rows = corpus(seed) + [(0, "a second text under the id"), (5000, "a second text under the id"), (5001, ""),
                           (None, "a second text under the id"), (1, corpus(seed)[0][1]), (1, corpus(seed)[1][1])]
    got = op.similarity_join(docs(spark, rows).repartition(3), width, num, den, heavy_tokens=200).collect()
    truth = brute(rows, width, num, den)
    sets = {(d, shingles(t, width)) for d, t in rows if d is not None}

    def linked(x, y):
        return bool(x) and bool(y) and den * len(x & y) >= num * len(x | y)

    want = [(d, truth[d], sum(e != d and linked(shingles(t, width), y) for e, y in sets)) if d is not None
            else (None, None, None) for d, t in rows]
    assert sorted(((x.doc_id, x.component_id, x.n_links) for x in got), key=str) == sorted(want, key=str)
    links, rows_of = op.similarity_links(docs(spark, rows), width, num, den)
    vertex = {(x.doc_id, x.n_shingles, x.class_id): x.vertex for x in rows_of.collect() if x.vertex is not None}
    classes = {y for _, y in sets if y}
    assert len(set(vertex.values())) == len(classes)
    found = [(x.a, x.b) for x in links.collect()]
    assert len(found) == len(set(found)) == sum(linked(x, y) for x in classes for y in classes if x != y) // 2


def test_awkward_rows(spark):
    rows = AWKWARD + [(20, "ONE two"), (21, "one  two\n"), (8, "another text under a used id"), (30, prose(40, 8)),
                      (31, "another text under a used id")]
    got = op.similarity_classes(docs(spark, rows, extra=True), 3, 90, 100).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for x in got:
        by[x.doc_id].add(x.component_id)
    assert by[None] == {None}
    assert by[1] == {1} and by[2] == {2} and by[3] == {3}
    assert by[5] == by[20] == by[21] == {5}
    assert by[8] == by[30] == by[31] == {8}
    assert {x.n_shingles for x in got if x.doc_id in (1, 2, 3)} == {0}
    kept = op.one_of_each(docs(spark, rows, extra=True), 3, 90, 100)
    assert sorted((x.doc_id for x in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, None, 7, 8, 9, 10], key=str)
    assert kept.first().id == "clash" and kept.columns == docs(spark, rows, extra=True).columns


def test_empty_table(spark):
    assert op.similarity_classes(docs(spark, [])).collect() == []
    assert op.one_of_each(docs(spark, [])).collect() == []


def test_signatures_of_linked_sets_meet():
    """Property of the index keys alone, for random sets, orders and frequent tokens."""
    r = np.random.default_rng(5)
    for _ in range(3000):
        n = int(r.integers(1, 200))
        num = int(r.choice([70, 80, 90]))
        universe = np.unique(r.integers(1, 1 << 62, 400).astype(np.uint64))
        x = np.sort(r.choice(universe, n, replace=False))
        y = x.copy()
        k = int(r.integers(0, max(1, n // 6) + 1))
        y = np.delete(y, r.choice(len(y), min(k, len(y)), replace=False))
        y = np.union1d(y, r.choice(universe, int(r.integers(0, k + 1))))
        shared = len(np.intersect1d(x, y))
        if 100 * shared < num * (len(x) + len(y) - shared) or (len(x) == len(y) == shared):
            continue
        heavy = np.sort(r.choice(universe, int(r.integers(0, 300)), replace=False))
        rank = r.permutation(len(heavy))
        a1, a2, _ = op.signatures(x, heavy, rank, num, 100)
        b1, b2, _ = op.signatures(y, heavy, rank, num, 100)
        assert np.intersect1d(a1, b1).size or np.intersect1d(a2, b2).size


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    got = {x.id: x.component for x in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == 1 for i in range(1, 61)) and all(got[i] == 100 for i in range(100, 140))
    assert got[150] == got[200] == 150 and len(got) == 60 + 40 + 2
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


def test_words_of_equal_polynomials_are_different_words(spark):
    rows = []
    for k, n in enumerate((1024, 2048, 4096)):
        rows += [(10 * k, f"x {thue_morse(n)} y z"), (10 * k + 1, f"x {thue_morse(n, 'b', 'a')} y z")]
    got = op.similarity_join(docs(spark, rows), 3, 90, 100).collect()
    assert {(x.doc_id, x.component_id, x.n_links) for x in got} == {(d, d, 0) for d, _ in rows}


def test_join_of_awkward_tables(spark):
    assert op.similarity_join(docs(spark, [])).collect() == []
    rows = AWKWARD + [(20, "ONE two"), (21, "one  two\n")]
    got = op.similarity_join(docs(spark, rows, extra=True), 3, 90, 100).collect()
    assert {x.doc_id: x.n_links for x in got if x.doc_id in (5, 20, 21, 1, 3)} == {5: 2, 20: 2, 21: 2, 1: 0, 3: 0}
    assert [x.n_links for x in got if x.doc_id is None] == [None]


def test_shared_tokens_of_many_sets(monkeypatch):
    r = np.random.default_rng(3)
    monkeypatch.setattr(op, "_COLUMNS", 7)
    sets = [np.unique(r.integers(0, 60, int(r.integers(0, 40))).astype(np.uint64)) for _ in range(25)] + [np.empty(0, np.uint64)]
    found = op._shared_tokens(sets)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            alone = i == j  # tokens that only one set holds are not counted
            assert alone or found[i, j] == len(np.intersect1d(x, y))


def test_finer_counts_never_part_linked_sets():
    r = np.random.default_rng(8)
    parted = 0
    for _ in range(400):
        n = int(r.integers(1, 3000))
        x = np.unique(r.integers(1, 1 << 62, n).astype(np.uint64))
        y = np.union1d(np.delete(x, r.choice(len(x), int(r.integers(0, len(x) // 2 + 1)), replace=False)),
                       r.integers(1, 1 << 62, int(r.integers(1, len(x) // 2 + 2))).astype(np.uint64))
        counts = [op._finer_counts(t) or op._class_counts(t).tobytes() for t in (x, y)]
        shared = len(np.intersect1d(x, y))
        could = op._could_link(*counts, len(x) + len(y), 80, 100)
        assert could or 100 * shared < 80 * (len(x) + len(y) - shared)
        parted += not could
    assert parted > 50
    many = np.zeros(2000, np.uint64) + np.uint64(7)  # one class holds more than a count can tell
    assert op._could_link(op._class_counts(many).tobytes(), op._class_counts(x).tobytes(), 10**6, 80, 100)


def test_long_documents_chained_by_chance_shingles(spark):
    """Long texts that share a few rare shingles with the next one, among them near copies at the threshold."""
    r = random.Random(12)
    texts = [[f"w{r.randrange(10**7)}" for _ in range(r.randrange(300, 360))] for _ in range(60)]
    for i, words in enumerate(texts[1:], 1):
        words[20:40] = texts[i - 1][200:220]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    rows += [(100 + i, edited(texts[i], k, r)) for i, k in ((3, 4), (9, 6), (9, 7), (21, 8), (33, 2))]
    got = op.similarity_classes(docs(spark, rows).repartition(3), 5, 80, 100).collect()
    truth = brute(rows, 5, 80, 100)
    assert {x.doc_id: x.component_id for x in got} == truth
    assert 60 <= len(set(truth.values())) < 64
    each, classes, trees = op._prepared(docs(spark, rows), 5, 80, 100, op.SKETCH_SLOTS)
    assert max(x["count"] for x in components(trees).groupBy("component").count().collect()) <= 4


def _moved_texts(df):
    """Scans of whole texts in the plan whose rows go to an exchange before any join with marks thins them out."""
    above, found = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        above = [(d, x) for d, x in above if d < depth]
        if "Scan" in line and "text#" in line:
            nearest = next((x for _, x in reversed(above) if "Exchange" in x or "BroadcastHashJoin" in x), "")
            found += [line] * ("Exchange" in nearest)
        above.append((depth, line))
    return found


def test_texts_stay_where_they_are_when_one_of_each_is_kept(spark):
    texts = [prose(40, i) for i in range(60)] + [prose(40, i) + " more" for i in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, texts[6])]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for given in (rows, rows[:80]):  # with and without a repeated id
            kept = op.one_of_each(docs(spark, given, extra=True), 3, 90, 100)
            assert not _moved_texts(kept)
            assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == list(range(60))
            assert kept.where("doc_id is null").count() == (len(given) > 80)
            assert kept.columns == docs(spark, [], extra=True).columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("slots", [64, 1 << 24])
def test_rows_are_parted_exactly_whatever_slots_they_share(spark, monkeypatch, slots):
    monkeypatch.setattr(op, "_SLOTS", slots)
    rows = docs(spark, [(i, f"text {i}") for i in range(-200, 300)] + [(None, "none"), (3, "again")], extra=True)
    ids = spark.range(-201, 400, 3).select(F.col("id").alias("doc_id"))
    gone = set(range(-201, 400, 3))
    parted = [sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in f(rows, ids).collect())
              for f in (op._without, op._within)]
    every = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in rows.collect())
    assert parted == [[r for r in every if r[1] not in gone], [r for r in every if r[1] in gone]]
