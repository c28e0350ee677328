import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from helpers import AWKWARD, docs, prose
from tickwise.llm import fingerprint as op


def counts(raw):
    c = Counter()
    for k in range(len(raw)):
        for salt, (i, j) in enumerate(((1, 2), (1, 3), (2, 3))):
            if k + j < len(raw):
                key = (raw[k] << 16 | raw[k + i] << 8 | raw[k + j]) + (salt << 24)
                c[(key * int(op._MUL[salt]) & 0xFFFFFFFF) >> 25] += 1
    return [c[b] for b in range(op.BUCKETS)]


def test_triplets_are_counted_whole(monkeypatch):
    monkeypatch.setattr(op, "_BLOCK", 50)
    for n in (0, 1, 2, 3, 4, 49, 50, 51, 52, 53, 54, 99, 100, 101, 102, 103, 500):
        raw = prose(200, n).encode()[:n]
        assert op.bucket_counts(raw).tolist() == counts(raw), n


def test_likeness():
    a, b = prose(400, 1), prose(400, 2)
    near = a.replace("alpha", "alfa")
    random.seed(1)
    other = "".join(random.choice("qwxzjv ") for _ in range(2000))
    assert op.likeness(op.digest(a), op.digest(a)) == 1.0
    assert op.likeness(op.digest(a), op.digest(near)) > op.likeness(op.digest(a), op.digest(other))
    for x in (a, b, near, other, "", None):
        for y in (a, other, ""):
            assert 0 <= op.difference(op.digest(x), op.digest(y)) <= op.BOUND
            assert op.difference(op.digest(x), op.digest(y)) == op.difference(op.digest(y), op.digest(x))
    assert op.digest("") == op.digest(None)


@pytest.mark.parametrize("parts,ranges", [(1, 1), (4, 3), (6, 40)])
def test_matches_brute_force(spark, parts, ranges):
    rows = AWKWARD + [(100 + i * 3, prose(i, i)) for i in range(60)]
    rows += [(8, prose(41, 8)), (None, "another without id"), (-5, "first of all \U0001f600é")]
    got = op.compare_with_next(docs(spark, rows, extra=True).repartition(parts), ranges).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1] is not None, (r[1] or "").encode()))
    want = []
    for k, (d, text) in enumerate(order):
        text, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + nxt[:half]
        want.append((d, len(text), hashlib.sha256(changed.encode()).hexdigest(), op.digest(text), op.digest(changed),
                     op.likeness(op.digest(text), op.digest(changed)), op.likeness(op.digest(text), op.digest(nxt))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_few_rows(spark):
    assert op.compare_with_next(docs(spark, [])).collect() == []
    [x] = op.compare_with_next(docs(spark, [(3, "alone here")])).collect()
    assert x.near_next == 1.0 and x.edited_sha256 == hashlib.sha256(b"alonealone").hexdigest()
    assert {r.fingerprint for r in op.fingerprints(docs(spark, [(1, "same"), (2, "same")])).collect()} == {op.digest("same")}
    assert np.isfinite(op.likeness(op.digest("a"), op.digest("b")))
