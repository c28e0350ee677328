import random

import pytest

from helpers import AWKWARD, docs, prose
from tickwise.llm import decontaminate as op

ITEM = "item_id bigint, text string"


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else set()


def brute(rows, items):
    found = []
    for d, text, *_ in rows:
        for i, item in items:
            n = len((item or "").split())
            if not n:
                continue
            own = shingles(item, min(5, n))
            shared = len(own & shingles(text, min(5, n)))
            if 5 * shared >= 4 * len(own):
                found.append((d, i, len(own), shared))
    return sorted(found, key=str)


def test_matches_brute_force(spark):
    r = random.Random(3)
    items = [(i, " ".join(f"w{r.randrange(500)}" for _ in range(r.randrange(1, 60)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, items[0][1]), (None, items[1][1])]
    rows = []
    for d in range(120):
        words = [f"w{r.randrange(500)}" for _ in range(r.randrange(0, 800))]
        for _ in range(r.randrange(3)):
            passage = items[r.randrange(40)][1].split()
            for _ in range(r.randrange(3)):  # edited copies, some still above the share
                passage[r.randrange(len(passage))] = "edited"
            at = r.randrange(len(words) + 1)
            words[at:at] = passage
        rows.append((d, " ".join(words).title() if d % 2 else "\n".join(words)))
    rows += AWKWARD
    got = op.contained_items(docs(spark, rows, extra=True), spark.createDataFrame(items, ITEM)).collect()
    assert sorted([(x.doc_id, x.item_id, x.item_shingles, x.shared) for x in got], key=str) == brute(rows, items)
    assert all(x.containment == x.shared / x.item_shingles for x in got)


def test_short_item_in_a_very_long_document(spark):
    item = prose(20, 1)
    rows = [(1, prose(40_000, 2) + " " + item + " " + prose(40_000, 3)), (2, prose(5000, 4))]
    got = op.contained_items(docs(spark, rows), spark.createDataFrame([(5, item)], ITEM)).collect()
    assert [(x.doc_id, x.item_id, x.containment) for x in got] == [(1, 5, 1.0)]


def test_blocks_give_the_same_pairs(spark, monkeypatch):
    items = [(i, prose(12, 1000 + i)) for i in range(30)]
    rows = [(d, prose(30, 500 + d) + " " + items[d % 30][1]) for d in range(60)]
    whole = sorted(map(tuple, op.contained_items(docs(spark, rows), spark.createDataFrame(items, ITEM)).collect()))
    monkeypatch.setattr(op, "BLOCK_ITEMS", 7)
    assert sorted(map(tuple, op.contained_items(docs(spark, rows), spark.createDataFrame(items, ITEM)).collect())) == whole
    kept = op.clean(docs(spark, rows + AWKWARD, extra=True), spark.createDataFrame(items, ITEM))
    assert kept.count() == len(AWKWARD) and kept.first().id == "clash"


@pytest.mark.parametrize("rows,items", [([], [(1, "a b c d e f")]), ([(1, "a b c d e f")], []), ([], [])])
def test_empty_tables(spark, rows, items):
    table = spark.createDataFrame(items, ITEM)
    assert op.contained_items(docs(spark, rows), table).collect() == []
    assert op.clean(docs(spark, rows), table).count() == len(rows)
