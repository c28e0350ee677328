"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

A word is a row of symbols. Leaf ``i`` of the tree holds the rank of the merge of symbol ``i`` and its right
neighbour together with ``i`` itself, so that the least leaf is the lowest rank and, of equal ones, the leftmost.
The root therefore names the next merge. A merge changes three leaves (the pair itself, the pair before it, the
vanished one), each a walk to the root, until the root holds no mergeable pair: n log n steps for a word of any
length, where rescanning a word costs n squared.

The vocabulary, merges, normaliser, splitting rule and added tokens are those of a tokenizers file whose splitting
rule drops white space, so what lies between two spaces is encoded on its own: each task keeps the ids of the words
it met (a bounded memory) and runs the tree for new ones. A table of ids decodes as that
file's own decoder does; a file with neither decoder nor byte fall-back joins the tokens by a space.

Cases: a null text is empty and has no ids; texts are encoded whole, in slices cut at a space, so a task holds one
text and its words' ids a slice at a time; a word of any length is one tree; repeated
rows and rows with a null or shared id give one result each; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tickwise.llm.common import map_rows

#: Words remembered by a Python worker (twice as many at most), and the longest one that is.
WORD_MEMORY = 250_000
WORD_LONGEST = 64
#: Characters of a text that are encoded at a time; a slice is cut at the next space.
SLICE = 1 << 13
_NEVER = 1 << 62
_LATIN = [chr(c) for c in range(0x250)]
_L = "".join(re.escape(c) for c in _LATIN if c.isalpha())
_N = "".join(re.escape(c) for c in _LATIN if c.isnumeric() and not c.isalpha())
_S = "".join(re.escape(c) for c in _LATIN if c.isspace() and not "\x1c" <= c <= "\x1f")
# Fixed value: the vocabulary's published splitting rule, with its letter, number and space classes written out for
# the characters below U+0250, which are in normal form already.
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_BEYOND = re.compile("[^\u0000-\u024f]")


def merged(symbols: list[int], ranks: dict[int, int], results: list[int]) -> list[int]:
    """Symbols (ids below 2^32) after all merges.

    ranks: left id << 32 | right id -> rank of the merge; results: id of the merged symbol by rank.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    width = 1 << (n - 1).bit_length()
    shift, mask, get = width.bit_length(), 2 * width - 1, ranks.get
    tree = [_NEVER] * (2 * width)
    leaf, left = width, symbols[0]
    for right in symbols[1:]:
        rank = get(left << 32 | right)
        if rank is not None:
            tree[leaf] = rank << shift | leaf
        leaf, left = leaf + 1, right
    for node in range(width + n - 2, 1, -1):  # each node hands its least leaf on to its parent
        least = tree[node]
        if least < tree[node >> 1]:
            tree[node >> 1] = least
    if tree[1] == _NEVER:
        return symbols
    # Leaves name positions; a vanished symbol is -1, and one -1 stands before the first and behind the last.
    at = [-1] * width + symbols + [-1] * (width - n + 1)
    after, before = list(range(1, 2 * width + 1)), list(range(-1, 2 * width))
    while (least := tree[1]) != _NEVER:
        left = least & mask
        right = after[left]
        at[left] = new = results[least >> shift]
        at[right] = -1
        after[left] = behind = after[right]
        before[behind] = left
        # Three leaves change; each walk ends where a node keeps its value.
        node, value = right, _NEVER
        while tree[node] != value:
            tree[node] = value
            if node == 1:
                break
            other = tree[node ^ 1]
            if other < value:
                value = other
            node >>= 1
        follower = at[behind]
        rank = get(new << 32 | follower) if follower >= 0 else None
        node, value = left, _NEVER if rank is None else rank << shift | left
        while tree[node] != value:
            tree[node] = value
            if node == 1:
                break
            other = tree[node ^ 1]
            if other < value:
                value = other
            node >>= 1
        first = before[left]
        if at[first] >= 0:
            rank = get(at[first] << 32 | new)
            node, value = first, _NEVER if rank is None else rank << shift | first
            while tree[node] != value:
                tree[node] = value
                if node == 1:
                    break
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
    return [s for s in at[width:] if s >= 0]


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class _Words(dict):
    """Words met, with what they encode to: looked up, and encoded when they are new.

    When the memory is full it becomes the older half; words found there move on, so frequent ones are never lost.
    """

    def __init__(self, encode: Callable[[str], tuple[bytes, str, int]]):
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> tuple[bytes, str, int]:
        found = self.older.get(word)
        if found is None:
            found = self.encode(word)
            if len(word) > WORD_LONGEST:
                return found
        if len(self) >= WORD_MEMORY:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Codec:
    """Encoder and decoder of one tokenizers file; truncation and padding that it may ask for are left out."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        if (model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges")
                or model.get("continuing_subword_prefix") or model.get("unk_token") or spec.get("decoder")
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)):
            raise ValueError(f"{path}: not a byte-pair vocabulary of the kind encoded here")
        whole = Tokenizer.from_file(path)
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        if self.splitter is None or self._words("a b \t\n c") != ["a", "b", "c"]:
            raise ValueError(f"{path}: the splitting rule keeps white space")
        vocabulary = model["vocab"]
        self.token = {i: t for t, i in vocabulary.items()} | {t["id"]: t["content"] for t in added}
        self.added = {t["content"]: t["id"] for t in added}
        contents = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None
        suffix = model.get("end_of_word_suffix") or ""
        self.inner, self.last = vocabulary, {t[:len(t) - len(suffix)]: i for t, i in vocabulary.items() if t.endswith(suffix)}
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.ranks = {vocabulary[a] << 32 | vocabulary[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.results = [vocabulary[a + b] for a, b in pairs]
        self.latin = self._is_known_rule(spec)
        self.letters = dict(enumerate(_byte_letters()))
        self.complete = all(c in self.inner and c in self.last for c in self.letters.values())
        self.words = _Words(lambda word: self._word(
            word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(self.letters)))

    @staticmethod
    def _is_known_rule(spec: dict) -> bool:
        """Whether the file's normaliser and splitting rule are those that _SPLIT restates."""
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        rules = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (steps == ["NFC", "Replace", "Lowercase"] and len(rules) == 2 and rules[0].get("pattern") == {"Regex": _RULE}
                and rules[1]["type"] == "ByteLevel" and not rules[1]["add_prefix_space"] and not rules[1]["use_regex"])

    def _words(self, text: str) -> list[str]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return [w for w, _ in self.splitter.pre_tokenize_str(text)]

    def _word(self, letters: str) -> tuple[bytes, str, int]:
        """(ids as little-endian unsigned 32-bit integers, their tokens, number) of one word of the splitting rule.

        ``letters``: one per byte. Letters that the vocabulary lacks are left out, as the library does.
        """
        if self.complete:
            ids = [*map(self.inner.__getitem__, letters[:-1]), self.last[letters[-1]]]
        else:
            ids = [self.inner.get(c, -1) for c in letters[:-1]] + [self.last.get(letters[-1], -1)]
            ids = [i for i in ids if i >= 0]
        found = merged(ids, self.ranks, self.results)
        return array("I", found).tobytes(), " ".join(map(self.token.__getitem__, found)), len(found)

    def _slice(self, text: str) -> Iterator[tuple[bytes, str, int]]:
        of_word = self.words.__getitem__
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.added:
                one = self.added[part]
                yield array("I", [one]).tobytes(), self.token[one], 1
            elif self.latin and not _BEYOND.search(low := part.lower()):
                yield from map(of_word, _SPLIT.findall(low))
            else:
                for chunk in part.split(" "):  # a chunk is normalised and split on its own
                    if self.latin and not _BEYOND.search(low := chunk.lower()):
                        yield from map(of_word, _SPLIT.findall(low))
                    else:
                        yield from map(self._word, self._words(chunk))

    def slices(self, text: str) -> Iterator[tuple[bytes, list[str], int]]:
        """(ids as little-endian unsigned 32-bit integers, words' tokens, number of ids), a slice of the text at a time."""
        at, n = 0, len(text)
        while at < n:
            end = n if n - at <= SLICE else text.find(" ", at + SLICE)
            end = n if end < 0 else end
            found = [p for p in self._slice(text[at:end]) if p[2]]
            if found:
                ids, tokens, sizes = zip(*found)
                yield b"".join(ids), tokens, sum(sizes)
            at = end + 1

    def encode(self, text: str | None) -> list[int]:
        out = array("I")
        for ids, _, _ in self.slices(text or ""):
            out.frombytes(ids)
        return out.tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens of the ids, added ones included; ids without a token are passed over."""
        return " ".join(self.token[i] for i in ids if i in self.token)


@lru_cache(maxsize=2)
def codec_of(path: str | None) -> Codec:
    """A Python worker reads a vocabulary once and keeps the words it met from task to task."""
    return Codec(path or vocabulary_path())


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _each(docs: DataFrame, path: str | None, result: Callable, fields: list) -> DataFrame:
    def run(rows):
        codec = codec_of(path)
        for doc_id, text in rows:
            yield (doc_id, *result(codec, text or ""))

    return map_rows(docs.select("doc_id", "text"), run, [("doc_id", pa.int64()), *fields], 128)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids of every whole text. ``path``: a vocabulary file all executors have; by default the public one."""
    return _each(docs, path, lambda codec, text: (codec.encode(text),), [("ids", pa.list_(pa.int64()))])


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of every row of (doc_id, ids); null ids are no ids."""
    def run(rows):
        codec = codec_of(path)
        for doc_id, ids in rows:
            yield doc_id, codec.decode(ids or ())

    return map_rows(tokens.select("doc_id", "ids"), run, [("doc_id", pa.int64()), ("text", pa.string())], 128)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what :func:`encoded` and :func:`decoded` give, as digests."""
    def result(codec: Codec, text: str) -> tuple[int, str, str]:
        ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
        for ids, tokens, size in codec.slices(text):
            if n:
                text_hash.update(b" ")
            ids_hash.update(ids)
            text_hash.update(" ".join(tokens).encode())
            n += size
        return n, ids_hash.hexdigest(), text_hash.hexdigest()

    return _each(docs, path, result, [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
