import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import AWKWARD, docs, prose
from tickwise.llm import langid as op

SF = "/root/testdata/sf0.01"


def brute_bits(train, text):
    """Code length by the definition: dictionaries of contexts, escapes by method C."""
    counts = defaultdict(Counter)
    for t in train:
        raw = b"\0\0\0" + t.encode()
        for k in range(3, len(raw)):
            for order in range(4):
                counts[raw[k - order:k], order][raw[k]] += 1
    raw, bits = b"\0\0\0" + text.encode(), 0.0
    for k in range(3, len(raw)):
        for order in (3, 2, 1, 0, -1):
            if order < 0:
                bits += 8
                break
            c = counts.get((raw[k - order:k], order))
            if c is None:
                continue
            total, distinct = sum(c.values()), len(c)
            if raw[k] in c:
                bits -= math.log2(c[raw[k]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
    return bits


def model_of(texts):
    langs = sorted(texts)
    grams = [(i, op._grams(op._padded(t.encode()))) for i, k in enumerate(langs) for t in texts[k]]
    lang = np.concatenate([np.full(len(g), i) for i, g in grams])
    return op.freeze(langs, lang, np.concatenate([g for _, g in grams]), np.ones(len(lang)))


def test_exact_code_lengths():
    texts = {"aa": ["abracadabra abra", "the cat sat"], "bb": ["le chat était là", "abra abra"]}
    model = model_of(texts)
    probes = ["abra", "zzz", "the chat", "é\u0000x", "q", "abracadabra" * 50]
    bits = model.text_bits([p.encode() for p in probes])
    for row, p in zip(bits, probes):
        assert row == pytest.approx([brute_bits(texts[k], p) for k in model.languages], rel=1e-5)


def test_long_texts_are_read_in_blocks(monkeypatch):
    model = model_of({"aa": [prose(50, 1)], "bb": [prose(50, 2).upper()]})
    raw = prose(3000, 3).encode()
    whole = model.text_bits([raw])
    monkeypatch.setattr(op, "_BLOCK", 1000)
    assert model.text_bits([raw])[0] == pytest.approx(whole[0], rel=1e-6)


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
def test_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = {x.doc_id: x for x in op.identify(table).collect()}
    test = [(got[x.doc_id], x.lang) for x in table.select("doc_id", "lang").collect()
            if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert all(x.held_out for x, _ in test) and sum(x.held_out for x in got.values()) == len(test)
    assert np.mean([x.lang_pred == y for x, y in test]) > 0.97
    assert all(0 <= x.score <= 1 for x in got.values())
    assert op.explained(table, op.train(table)).count() == table.count()


def test_held_out_languages_and_other_columns_do_not_matter(spark):
    rows = [(d, prose(30, d) if d % 2 else prose(30, d)[::-1], "en" if d % 2 else "ne") for d in range(120)]
    flip = [(d, t, {"en": "ne", "ne": "en"}[x] if zlib.crc32(str(d).encode()) % 4 == 2 else x) for d, t, x in rows]
    one = {x.doc_id: (x.lang_pred, x.bits_per_byte) for x in op.identify(docs(spark, rows)).collect()}
    two = {x.doc_id: (x.lang_pred, x.bits_per_byte) for x in op.identify(docs(spark, flip, extra=True)).collect()}
    assert one == two and all(one[d][0] == x for d, _, x in rows)


def test_sample_is_bounded_and_repeatable(spark):
    rows = [(d, prose(100, d)) for d in range(400)]
    few = op.train(docs(spark, rows), train_bytes=5000)
    again = op.train(docs(spark, rows[::-1]), train_bytes=5000)
    every = op.train(docs(spark, rows))
    assert len(few.keys4) < len(every.keys4) and (few.keys4 == again.keys4).all()


def test_awkward_rows(spark):
    got = op.identify(docs(spark, AWKWARD + [(11, "1 2 3"), (12, "é")], extra=True)).collect()
    assert len(got) == len(AWKWARD) + 2
    for x in got:
        if x.doc_id in (1, 2, 3, 9, 11):
            assert (x.lang_pred, x.score) == ("und", 0.0)
        elif x.doc_id in (7, 8, 12):
            assert x.lang_pred == "en"
        if x.doc_id is None:
            assert not x.held_out
    kept = op.explained(docs(spark, AWKWARD, extra=True), op.train(docs(spark, AWKWARD)))
    assert {1, 2, 3, 9}.isdisjoint({x.doc_id for x in kept.collect()}) and kept.columns[0] == "doc_id"


ITALIAN = ("Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita; "
           "quanto a dir qual era cosa dura esta selva selvaggia e aspra e forte che nel pensier rinova la paura")
FINNISH = ("Kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan; heille on annettu jarki ja "
           "omatunto, ja heidan on toimittava toisiaan kohtaan veljeyden hengessa")


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
def test_only_learned_languages_are_explained(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null")
    model = op.train(table)
    assert (op.limits(table, model) <= 8).all()
    strange = [(10**9 + i, t, None) for i, t in enumerate([ITALIAN, FINNISH, "deadbeef0123a9" * 20])]
    kept = op.explained(table.select("doc_id", "text", "lang").unionByName(
        docs(spark, strange).select("doc_id", "text", "lang")), model).select("doc_id").collect()
    clean = [x.doc_id for x in table.select("doc_id").collect()]
    assert sorted(x.doc_id for x in kept) == sorted(clean)
    assert any(zlib.crc32(str(d).encode()) % 4 == 2 for d in clean)


def test_nothing_to_learn(spark):
    assert op.identify(docs(spark, [])).collect() == []
    only = op.identify(docs(spark, [(1, "text", None), (2, None)])).collect()
    assert {x.lang_pred for x in only} == {"und"}
