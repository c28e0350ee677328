import zlib

import numpy as np
import pytest

from helpers import AWKWARD, docs, prose
from tickwise.llm import packing as op

public_tokenizers = pytest.importorskip("public_tokenizers")


def reference(text):
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode(text or "", add_special_tokens=False).ids


TEXTS = ["a b  c\n\n d", "don't I'LL we've ²³ ½x 12ab <|endoftext|> x", "naïve ǆ ɏ ɐ", "\x1c\x1d a\x85b", "тест 日本", " ",
         "a \t b", "ª º µ ˈ", "'s's 'd", "a\n \nb", " a \nb", "\u3000x y", "x \u3000y", "a 日 b", "a 's", "a'", "a ",
         "a\n b\nc", "é\xa0x y", " x", "\U0001f600 \u200d", "tab\there", "x" * 5000, "ends.\nWith lines,\nand \"quotes\""]


def test_word_memory_gives_the_tokenizers_ids(monkeypatch):
    texts = TEXTS + ["".join(chr(c) + " " + chr(c) + "x1 " for c in range(0x250)), prose(500, 1)]
    for memory in (op.WORD_MEMORY, 3):
        monkeypatch.setattr(op, "WORD_MEMORY", memory)
        encode = op.byte_bpe()()
        for t in texts * 2:
            assert np.frombuffer(encode(t), "<u2").tolist() == reference(t), t


def test_word_memory_is_bounded_and_keeps_frequent_words(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(op, "WORD_MEMORY", 50)
    parts = op._Parts(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    words, made = op._Words(None, parts), []
    ids = words.ids
    words.ids = lambda word: made.append(word) or ids(word)
    for i in range(300):
        assert words["often"] == parts.ids(" often")
        words["".join(chr(97 + int(d)) for d in str(i))]
    assert len(words) <= 50 and len(words.older) <= 50 and made.count("often") == 1
    assert not parts  # a plain word is remembered once, not in both memories
    words["x" * 5000]
    assert "x" * 5000 not in words


def test_a_part_is_tokenized_once_whatever_stands_around_it(monkeypatch):
    made, ids = [], op._Parts.ids
    monkeypatch.setattr(op._Parts, "ids", lambda self, part: made.append(part) or ids(self, part))
    words_made, word_ids = [], op._Words.ids
    monkeypatch.setattr(op._Words, "ids", lambda self, word: words_made.append(word) or word_ids(self, word))
    encode = op.byte_bpe()()
    for t in ["so many words", "so, many. words!", "so many,\nwords.\nso", "many  words, words.", "so many words" * 2]:
        assert np.frombuffer(encode(t), "<u2").tolist() == reference(t), t
    # Words with other marks behind them are no words of their own.
    assert len(made) == len(set(made)) and made.count(" words") == 1 and not words_made


def test_new_parts_of_many_texts_are_merged_together(monkeypatch):
    from tokenizers import Tokenizer

    untouched = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(7)
    letters = list("aaabbeinost'., \n1é")
    texts = TEXTS + [t or "" for _, t in AWKWARD] + [prose(500, 1), "aaaaaaa aaaa aaa", "x" * 64 + " " + "x" * 65,
                     "".join(chr(c) + " " + chr(c) + "x1 " for c in range(0x250))]
    texts += ["".join(rng.choice(letters, 400)) for _ in range(50)]
    expected = [untouched.encode(t, add_special_tokens=False).ids for t in texts]
    for memory in (op.WORD_MEMORY, 300, 3):
        monkeypatch.setattr(op, "WORD_MEMORY", memory)
        encode = op.byte_bpe()()
        for start, step in ((0, len(texts)), (0, 7), (3, 1)):
            for i in range(start, len(texts), step):
                got = [np.frombuffer(b, "<u2").tolist() for b in encode.many(texts[i:i + step])]
                assert got == expected[i:i + step]
    monkeypatch.setattr(op._Parts, "ids", lambda self, part: pytest.fail(f"{part!r} tokenized on its own"))
    encode = op.byte_bpe()()
    assert encode.many(["so many words", "", "so, many. words!"]) == [encode("so many words"), b"", encode("so, many. words!")]
    assert encode.many([]) == []


def test_joined_texts_are_cut_like_single_ones():
    rng = np.random.default_rng(11)
    letters = list("ase rvl1é²'!\n \x85\xa0\x1c\t'ɏ")
    texts = [t for t in TEXTS if not op._BEYOND.search(t)] + [
        "", "", "'s", "x'll've", "''s 's", " \xa0'd", "a\x85", "\xa0 ", "x" + "".join(map(chr, range(0x250)))]
    texts += ["".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(3000)]
    parts = [part for t in texts for part in [*op._SPLIT.findall(t), op._EDGE]]
    data = "".join(t + op._EDGE for t in texts).encode()
    size = [len(part.encode()) for part in parts]
    assert op._starts(data).tolist() == (np.cumsum(size) - size).tolist()


def test_parts_of_many_texts_are_looked_up_together(monkeypatch):
    class NoSplit:
        def findall(self, text):
            pytest.fail(f"{text!r} cut on its own")

    from tokenizers import Tokenizer

    untouched = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [prose(300, k) for k in range(4)] + ["", "often, often", "x" * 65 + " often"]
    expected = [untouched.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(op, "_SPLIT", NoSplit())
    monkeypatch.setattr(op, "WORD_MEMORY", 50)
    encode, made, ids = op.byte_bpe()(), [], op._Merges.ids
    monkeypatch.setattr(op._Merges, "ids", lambda self, parts: made.extend(parts.to_pylist()) or ids(self, parts))
    assert [np.frombuffer(b, "<u2").tolist() for b in encode.many(texts)] == expected
    assert len(made) == len(set(made)) and "x" * 65 not in made + encode.table.parts.to_pylist()
    made.clear()
    for i in range(300):
        text = "often, " + "".join(chr(97 + int(d)) for d in str(i))
        got = encode.many([text])
        assert np.frombuffer(got[0], "<u2").tolist() == untouched.encode(text, add_special_tokens=False).ids
        assert i < 100 or len(encode.table.parts) <= 1 + 2 * 50
    assert "often" not in made and "," not in made  # frequent ones stay, in a memory of two halves
    monkeypatch.setattr(op, "BLOCK", 80)  # a large text's parts beyond a bound are not remembered
    encode = op.byte_bpe()()
    assert np.frombuffer(encode.many([texts[0]])[0], "<u2").tolist() == expected[0]
    assert len(encode.table.parts) == 1 + 80 // 8


def test_merges_out_of_order_are_left_to_the_tokenizer(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"].reverse()
    path = tmp_path / "reversed.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    encode, untouched = op.byte_bpe(str(path))(), Tokenizer.from_file(str(path))
    texts = ["a b  c\n\n d", prose(300, 2)]
    assert encode.merges is None
    assert [np.frombuffer(b, "<u2").tolist() for b in encode.many(texts)] == [
        untouched.encode(t, add_special_tokens=False).ids for t in texts]


def test_blocks_are_bounded(monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 10)
    monkeypatch.setattr(op, "BLOCK_TEXTS", 3)
    rows = [(i, t) for i, t in enumerate(["a" * 6, "b" * 6, "c" * 50, None, "d", "e", "f"])]
    blocks = [*op._blocks(iter(rows))]
    assert [[i for i, _ in b] for b in blocks] == [[0], [1], [2], [3, 4, 5], [6]]
    assert [r for b in blocks for r in b] == [(i, t or "") for i, t in rows]


def test_added_tokens_have_their_ids():
    from tokenizers import Tokenizer

    untouched = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = op.byte_bpe()()
    assert np.frombuffer(encode("a <|endoftext|> b"), "<u2").tolist() == [64, 220, 50256, 275]
    for t in [*TEXTS, "<|endoftext|>", "x<|endoftext|>y  z", "тест <|endoftext|>\n\n", "<|endoftext|><|endoftext|> <|end"]:
        assert np.frombuffer(encode(t), "<u2").tolist() == untouched.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("parts", [1, 5])
def test_round_trip(spark, parts):
    rows = [r for r in AWKWARD] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(300, prose(6000, 3))]
    packed = op.pieces(docs(spark, rows, extra=True).repartition(parts), window=256).collect()
    # Windows: gapless from 0, full but for the last.
    by = {}
    for p in packed:
        by.setdefault(p.sequence_id, []).append(p)
    assert sorted(by) == list(range(len(by)))
    for k, ps in by.items():
        ps.sort(key=lambda p: p.offset)
        at = 0
        for p in ps:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == 256 or k == len(by) - 1
    # Each id lies in exactly one piece.
    whole = {}
    for p in sorted(packed, key=lambda p: (p.sequence_id, p.offset)):
        ids = np.frombuffer(p.ids, "<u2")
        assert p.length == len(ids) and p.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        whole.setdefault(p.doc_id, []).append((p.start, ids.tolist(), p.doc_tokens))
    for doc_id, ps in whole.items():
        texts = [reference(t) + [1] for d, t in rows if d == doc_id]
        runs, done = [], []
        for start, ids, total in ps:
            if start == 0:
                runs.append([])
            assert start == len(runs[-1])
            runs[-1] += ids
            if len(runs[-1]) == total:
                done.append(runs[-1])
        assert sorted(done) == sorted(texts)


def test_sequences_and_padding(spark):
    packed = op.pieces(docs(spark, [(i, prose(50, i)) for i in range(30)]), window=128)
    made = {x.sequence_id: x for x in op.sequences(packed, 128, pad_id=0).collect()}
    last = made[max(made)]
    assert all(len(x.ids) == 128 for x in made.values() if x.sequence_id != last.sequence_id)
    n = last.n_tokens
    assert len(last.ids) == (n if n & (n - 1) == 0 else 128) and set(last.ids[n:]) <= {0}


def test_empty_table(spark):
    assert op.pieces(docs(spark, [])).collect() == []


def test_arrow_batches_are_bounded_and_a_smaller_bound_stays(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, kept in (("10000", "512"), ("0", "512"), ("-1", "512"), ("7", "7")):
            spark.conf.set(key, given)
            op.tokenized(docs(spark, [(1, "a b")]))
            assert spark.conf.get(key) == kept
    finally:
        spark.conf.set(key, before)
