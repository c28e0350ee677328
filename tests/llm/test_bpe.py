"""Byte-pair encoding against the untouched library and against merging by rescans."""

import hashlib
import json
import random
from array import array

import pytest
from helpers import AWKWARD, docs, prose

from tickwise.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    whole = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    whole.no_truncation()
    whole.no_padding()
    return whole


def strange(n, seed):
    r = random.Random(seed)
    ranges = [(32, 127), (0x80, 0x500), (0x300, 0x370), (1, 0xD7FF), (0xE000, 0x11FFF), (32, 40), (9, 33), (0x1E00, 0x2200)]
    return ["".join(chr(r.randrange(*r.choice(ranges))) for _ in range(r.randrange(60))) for _ in range(n)]


TEXTS = ["", "   ", "\n\n\t", "It's don't I'LL WE'VE 'tis", "a <|endoftext|>b<|startoftext|><|endoftext|> <|ENDOFTEXT|>",
         "x" * 5000, "İstanbul ΣΣς ßẞ ﬁ Å Å ﬁ ½²ⅷ 12345", "a b　c​d\x85e\x1cf", "é ́e 日本語 \U0001f600가각"]


def by_rescans(symbols, ranks, results):
    symbols = list(symbols)
    while True:
        found = [(ranks[a << 32 | b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 32 | b in ranks]
        if not found:
            return symbols
        rank, i = min(found)
        symbols[i:i + 2] = [results[rank]]


def test_tree_merges_as_rescans_do():
    r = random.Random(1)
    for _ in range(2000):
        pairs = {r.randrange(6) << 32 | r.randrange(6) for _ in range(r.randrange(20))}
        order = r.sample(sorted(pairs), len(pairs))
        ranks, results = {p: k for k, p in enumerate(order)}, [r.randrange(6) for _ in order]
        symbols = [r.randrange(6) for _ in range(r.randrange(40))]
        # Merged symbols may merge again: every merge makes the row one shorter, so both end.
        assert bpe.merged(list(symbols), ranks, results) == by_rescans(symbols, ranks, results)


def test_ids_and_texts_are_the_librarys(library):
    codec = bpe.codec_of(None)
    for text in TEXTS + strange(1500, 2) + [prose(300, 3), " ".join(strange(400, 4))]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_slices_do_not_show(library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 7)
    codec = bpe.Codec(bpe.vocabulary_path())
    for text in TEXTS + strange(200, 5) + [prose(300, 6), "ab " * 50 + "<|endoftext|> " * 9]:
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_word_memory_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_MEMORY", 3)
    codec = bpe.Codec(bpe.vocabulary_path())
    text = prose(200, 7)
    assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_long_word(library):
    word = "".join(random.Random(8).choice("abcdefgh") for _ in range(60_000))
    assert bpe.codec_of(None).encode(word) == library.encode(word, add_special_tokens=False).ids


def test_digests(spark, library):
    rows = AWKWARD + [(20 + i, t) for i, t in enumerate(TEXTS)] + [(60, prose(20_000, 9))]
    for extra in (False, True):
        found = bpe.digests(docs(spark, rows, extra)).collect()
        want = []
        for doc_id, text in ((r[0], r[1]) for r in rows):
            ids = library.encode(text or "", add_special_tokens=False).ids
            told = library.decode(ids, skip_special_tokens=False)
            want.append((doc_id, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                         hashlib.sha256(told.encode()).hexdigest()))
        assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_encoded_and_decoded_tables(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None)]
    tokens = bpe.encoded(docs(spark, rows))
    assert {r["doc_id"]: r["ids"] for r in tokens.collect()} == {
        i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    assert {r["doc_id"]: r["text"] for r in bpe.decoded(tokens).collect()} == {
        i: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for i, t in rows}


def test_empty_table(spark):
    assert bpe.digests(docs(spark, [])).collect() == []


def test_other_kinds_of_vocabularies_are_refused(tmp_path):
    with open(bpe.vocabulary_path(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["unk_token"] = "!"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.Codec(str(path))
