"""Concatenate-and-cut packing by prefix sums.

Pass one tokenizes every document once, writes its ids with their running offset inside the partition and
thereby the partition's token total; the prefix sum over those totals (one row per partition) gives every
partition its global base. Pass two places each document at base + offset and cuts it at the window borders:
window ``k`` is sequence ``k``, and a document that crosses a border leaves a boundary record on each side. No
row is shuffled, and all sequences but the last are full.

Cases: a null text is empty and still carries its end id; repeated rows are packed as often as they occur;
null ids are kept; a text of any length is cut into as many pieces as it needs; an empty table gives no row.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import map_rows, written

WINDOW = 2048
END_ID = 1
#: Parts, and words, remembered by a tokenizing task, in each of two halves; longer ones than WORD_LONGEST never are,
#: nor, of the parts of a block, those of more than SIZES[-1] bytes.
WORD_MEMORY = 131_072
WORD_LONGEST = 64
#: Characters, and texts, whose parts are looked up together.
BLOCK, BLOCK_TEXTS = 1 << 21, 1 << 13
#: Parts of like size that are merged together, and the sizes in bytes that bound their groups.
MERGED, SIZES = 8192, (0, 4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 64)
_NEVER, _PLACES = 1 << 24, 64  # a rank none has; places of a part of at most SIZES[-1] bytes
_LATIN = [chr(c) for c in range(0x250)]
_L = "".join(re.escape(c) for c in _LATIN if c.isalpha())
_N = "".join(re.escape(c) for c in _LATIN if c.isnumeric() and not c.isalpha())
_S = "".join(re.escape(c) for c in _LATIN if c.isspace() and not "\x1c" <= c <= "\x1f")
# Fixed value: the vocabulary's published splitting rule, with its letter, number and space classes written
# out for the characters below U+0250. Words with any other character go to the tokenizer whole.
_SPLIT = re.compile(rf" [{_L}]+|[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND = re.compile("[^\u0000-ɏ]")
_GAPS = re.compile(r"\s\s")
#: Stands behind each of several joined texts; none of them holds it.
_EDGE = "\u0250"
_LETTER, _NUMBER, _OTHER, _SPACE, _BEHIND = range(5)
_KIND = np.array([_LETTER if c.isalpha() else _NUMBER if c.isnumeric() else _SPACE if re.match(f"[{_S}]", c) else _OTHER
                  for c in _LATIN] + [_BEHIND], np.uint8)


def _starts(data: bytes) -> np.ndarray:
    """Where the splitting rule's parts start in joined texts; an edge is a part of its own."""
    raw = np.frombuffer(data, np.uint8)
    kind = np.frombuffer(bytearray(data).translate(_KIND[:256].tobytes()), np.uint8)
    lead = np.flatnonzero(raw >= 0xC0)  # of two bytes, which are both of the character's kind
    kind[lead] = kind[lead + 1] = _KIND[(raw[lead] & 0x1F).astype(np.uint16) << 6 | raw[lead + 1] & 0x3F]
    start = np.append(True, kind[1:] != kind[:-1])
    start[lead[kind[lead] == _BEHIND]] = True
    # Of white space before a word the last character is cut off; a space belongs to the word.
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] < _SPACE))
    start[last - (raw[last] >= 0x80)] = True
    start[last[raw[last] == 0x20] + 1] = False
    # 's, 't, 'm, 'd, 're, 've and 'll where a part starts.
    mark = np.flatnonzero(raw == 0x27)
    mark = mark[start[mark]]
    one, two = raw[mark + 1], raw[mark + 1].astype(np.uint16) << 8 | raw[mark + 2]
    for held, size in ((np.isin(one, np.frombuffer(b"stmd", np.uint8)), 2),
                       (np.isin(two, np.frombuffer(b"revell", ">u2")), 3)):
        start[mark[held] + 1] = False
        start[mark[held] + size] = True
    return np.flatnonzero(start)


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class _Memory(dict):
    """Ids by word, made when a word is new.

    When the memory is full it becomes the older half; words found there move on, so frequent ones are never lost
    and a vocabulary of any size takes two halves at most.
    """

    def __init__(self):
        self.older: dict[str, bytes] = {}

    def ids(self, word: str) -> bytes:
        raise NotImplementedError

    def known(self, word: str) -> bytes | None:
        return self.get(word) or self.older.get(word)

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.ids(word)
            if len(word) > WORD_LONGEST:
                return found
        if len(self) >= WORD_MEMORY:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class _Parts(_Memory):
    """Ids of the splitting rule's parts."""

    def __init__(self, bpe):
        super().__init__()
        self.model, self.letters = bpe.model, dict(enumerate(_byte_letters()))

    def ids(self, part: str) -> bytes:
        spelled = part.encode().decode("latin-1").translate(self.letters)
        return array("H", [t.id for t in self.model.tokenize(spelled)]).tobytes()


class _Merges:
    """Ids of many of the splitting rule's parts at once: in every round each part has its lowest merge made, the first
    of equal ones."""

    def __init__(self, vocabulary: dict[str, int], pairs: list[tuple[str, str]]):
        left, right, self.made = (np.array([vocabulary[t] for t in column], np.uint32) for column in
                                  ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        key = left << 16 | right
        order = np.argsort(key)
        self.keys, self.rank = np.append(key[order], np.uint32(0xFFFFFFFF)), np.append(order, _NEVER).astype(np.int32)
        # A slot holds its one pair and that one's rank; pairs of crowded slots are searched for among all.
        slot, held = self._slot(key), np.bincount(self._slot(key), minlength=1 << 19)
        self.slot_key = np.full(1 << 19, 0xFFFFFFFE, np.uint32)
        self.slot_key[slot] = np.where(held[slot] > 1, np.uint32(0xFFFFFFFF), key)
        self.slot_rank = np.full(1 << 19, _NEVER, np.int32)
        self.slot_rank[slot] = np.arange(len(key))
        self.made = self.made.astype(np.uint16)
        self.letter = np.array([vocabulary[c] for c in _byte_letters()], np.uint16)
        self.first = self._ranks(np.repeat(self.letter, 256), np.tile(self.letter, 256))  # by two bytes
        # The rank that makes a token; letters are there from the start.
        making = np.full(1 << 16, -1, np.int32)
        making[self.made] = rank = np.arange(len(pairs), dtype=np.int32)
        self.in_order = bool((making[self.made] == rank).all() and (making[left] < rank).all()
                             and (making[right] < rank).all() and (making[self.letter] < 0).all())

    @classmethod
    @lru_cache(maxsize=1)  # some MB a worker
    def of(cls, path: str) -> _Merges | None:
        """None for a file whose merges are not of this kind; its parts are left to the tokenizer."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                "ignore_merges")):
            return None
        vocabulary, pairs = model["vocab"], [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        if not pairs or max(vocabulary.values()) >= 0xFFFF or not all(c in vocabulary for c in _byte_letters()):
            return None
        merges = cls(vocabulary, pairs)
        return merges if merges.in_order else None

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key * np.uint32(0x9E3779B1) >> np.uint32(13)).astype(np.intp)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.uint32) << np.uint32(16) | right
        slot = self._slot(key)
        held = self.slot_key[slot]
        rank = np.where(held == key, self.slot_rank[slot], np.int32(_NEVER))
        crowded = np.flatnonzero(held == 0xFFFFFFFF)
        if len(crowded):
            key = key[crowded]
            at = np.searchsorted(self.keys, key)
            rank[crowded] = np.where(self.keys[at] == key, self.rank[at], _NEVER)
        return rank

    def ids(self, parts: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of each part; none is empty or longer than ``SIZES[-1]`` bytes."""
        ends = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset:parts.offset + len(parts) + 1]
        data, size = np.frombuffer(parts.buffers()[2] or b"", np.uint8), np.diff(ends).astype(np.int32)
        number, lengths, ids = [np.empty(0, np.intp)], [np.empty(0, np.int32)], [np.empty(0, np.uint16)]
        for below, most in pairwise(SIZES):
            group = np.flatnonzero((size > below) & (size <= most))
            for at in range(0, len(group), MERGED):
                some = group[at:at + MERGED]
                for done, length, symbols in self._merged(data, ends[some], size[some], most):
                    number.append(some[done])
                    lengths.append(length)
                    ids.append(symbols)
        made = _binary(np.concatenate(ids).astype("<u2").tobytes(), 2 * np.concatenate(lengths).astype(np.int64))
        return made.take(pa.array(np.argsort(np.concatenate(number))))

    def _merged(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, most: int
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of parts that are done, how many ids each has, and the ids; a part is a column of its symbols."""
        row = np.arange(most, dtype=np.int32)[:, None]
        letters = data[start + np.minimum(row, size - 1)]
        symbol = np.where(row < size, self.letter[letters], np.uint16(0xFFFF))  # no pair has the one behind the end
        # A place's code is the rank of its merge with the next one, then the place itself.
        code = self.first[letters[:-1].astype(np.uint16) << 8 | letters[1:]]
        code = np.where(row[1:] < size, code, np.int32(_NEVER)) * np.int32(_PLACES) + row[:-1]
        number = np.arange(len(size))
        while len(number):
            least = code.min(axis=0, initial=_NEVER * _PLACES)
            done = least == _NEVER * _PLACES
            if done.any():
                yield number[done], size[done], symbol.T[done][row[:len(symbol), 0] < size[done][:, None]]
                rest = np.flatnonzero(~done)
                number, size, least = number[rest], size[rest], least[rest]
                symbol, code = symbol.take(rest, axis=1), code.take(rest, axis=1)
            place, made, column = least % _PLACES, self.made[least // _PLACES], np.arange(len(number))
            behind = row[:len(symbol) - 1] > place
            symbol = np.where(behind, symbol[1:], symbol[:-1])
            symbol[place, column] = made
            code = np.where(behind[:-1], code[1:] - np.int32(1), code[:-1])
            size = size - 1
            for left in (place - 1, place):
                some = np.flatnonzero((left >= 0) & (left < len(code)))
                at, on = left[some], column[some]
                code[at, on] = self._ranks(symbol[at, on], symbol[at + 1, on]) * np.int32(_PLACES) + at


def _binary(data: bytes, size: np.ndarray) -> pa.LargeBinaryArray:
    ends = np.append(np.int64(0), np.cumsum(size, dtype=np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)])


class _Table:
    """Ids by part in two halves, like a ``_Memory``, for all parts of a block at once; the edge stands first."""

    def __init__(self):
        self.parts, self.ids, self.newer = pa.array([_EDGE], pa.large_string()), pa.array([b""], pa.large_binary()), 0

    def find(self, parts: pa.Array) -> np.ndarray:
        """Each part's place in the table, -1 for none."""
        return pc.index_in(parts, value_set=self.parts).fill_null(-1).to_numpy()

    def known(self, parts: list[str]) -> dict[str, bytes]:
        at = self.find(pa.array(parts, pa.large_string())) if len(self.parts) > 1 else []
        return {part: self.ids[i].as_py() for part, i in zip(parts, at) if i > 0}

    def remember(self, parts: pa.Array, ids: pa.Array, used: np.ndarray) -> None:
        """Keep new parts, and those of the older half that were used; a half holds one block's at least, of a block
        that is one large text as many as BLOCK // 8."""
        size, newer = len(self.parts), np.arange(1, 1 + self.newer)
        older = used[self.newer + 1:size]
        found = np.append(np.flatnonzero(older) + self.newer + 1, np.arange(size, size + len(parts)))[:BLOCK // 8]
        if not len(found):
            return
        if len(newer) + len(found) > WORD_MEMORY:
            halves = found, newer
        else:
            halves = np.append(newer, found), np.flatnonzero(~older) + self.newer + 1
        order = pa.array(np.concatenate(([0], *halves)))
        self.parts = pa.concat_arrays([self.parts, parts]).take(order)
        self.ids = pa.concat_arrays([self.ids, ids]).take(order)
        self.newer = len(halves[0])


class _Words(_Memory):
    """Ids of a space and the word behind it, by word; for texts with words that go to the tokenizer whole."""

    def __init__(self, bpe, parts: _Parts):
        super().__init__()
        self.bpe, self.parts = bpe, parts

    def ids(self, word: str) -> bytes:
        text = " " + word
        if word.isalpha() and word.isascii():
            return self.parts.known(text) or self.parts.ids(text)  # remembered here, not there as well
        if _BEYOND.search(word):
            return array("H", self.bpe.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.parts.__getitem__, _SPLIT.findall(text)))


class _Encoder:
    """A text's ids as little-endian unsigned 16-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.bpe = Tokenizer.from_file(path)
        # An added token is one id wherever its content stands, so texts that hold one go to the tokenizer whole.
        self.added = [t.content for t in self.bpe.get_added_tokens_decoder().values()]
        self.parts, self.merges = _Parts(self.bpe), _Merges.of(path)
        self.words, self.table = _Words(self.bpe, self.parts), _Table()

    def _whole(self, text: str) -> bytes:
        if _BEYOND.search(text):
            return array("H", self.bpe.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.parts.__getitem__, _SPLIT.findall(text)))

    def _is_plain(self, text: str) -> bool:
        """Whether the splitting rule is written out for all characters, and no added token may lie in the text."""
        return (text.isascii() or not _BEYOND.search(text)) and not any(content in text for content in self.added)

    def __call__(self, text: str) -> bytes:
        if self._is_plain(text):
            parts = _SPLIT.findall(text)
            known = self.table.known([part for part in {*parts} if part not in self.parts])
            return b"".join([known.get(part) or self.parts[part] for part in parts])
        if any(content in text for content in self.added) or _GAPS.search(text):
            return array("H", self.bpe.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        return self._whole(first) + b"".join(map(self.words.__getitem__, rest))

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each; texts are cut and looked up together, and parts that are new are merged together."""
        if self.merges is None:
            return [*map(self, texts)]
        plain = [*map(self._is_plain, texts)]
        made = iter(self._joined([text for text, held in zip(texts, plain) if held]))
        return [next(made) if held else self(text) for text, held in zip(texts, plain)]

    def _joined(self, texts: list[str]) -> list[bytes]:
        """The ids of plain texts, whose parts are looked up together."""
        if not texts:
            return []
        data = "".join([text + _EDGE for text in texts]).encode()
        starts = _starts(data)
        parts = pa.Array.from_buffers(pa.large_string(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
        at = self.table.find(parts)
        missing = np.flatnonzero(at < 0)
        size, at = len(self.table.parts), at.copy()
        new = parts.take(pa.array(missing)).dictionary_encode()
        at[missing] = new.indices.to_numpy() + size
        # Long ones, which are not remembered, go behind the others.
        is_long = np.diff(np.frombuffer(new.dictionary.buffers()[1], np.int64)[:len(new.dictionary) + 1]) > SIZES[-1]
        short, long = (new.dictionary.filter(pa.array(held)) for held in (~is_long, is_long))
        if len(long):
            place = np.where(is_long, len(short) + np.cumsum(is_long), np.cumsum(~is_long)) - 1
            at[missing] = place[at[missing] - size] + size
        made = self.merges.ids(short)
        ids = pa.concat_arrays([self.table.ids, made, pa.array([*map(self.parts.ids, long.to_pylist())], pa.large_binary())])
        self.table.remember(short, made, np.bincount(at, minlength=size) > 0)
        _, ends, flat = ids.take(pa.array(at)).buffers()
        behind = np.frombuffer(ends, np.int64)[np.flatnonzero(at == 0)].tolist()
        flat = memoryview(flat or b"")
        return [bytes(flat[start:end]) for start, end in zip([0, *behind], behind)]


def byte_bpe(path: str | None = None) -> Callable[[], Callable[[str], bytes]]:
    """Factory of a function from a text to its ids as little-endian unsigned 16-bit bytes.

    ``path``: the tokenizer file; by default the public 50k byte-level vocabulary, whose ids fit 16 bits. A part's
    ids depend on the part alone, so a text is cut into parts in one pass, and each distinct part is tokenized once
    and then looked up; the function's ``many`` takes a list of texts, cuts them and looks their parts up in Arrow
    arrays, all at once, and merges the parts that are new to it together, by the file's merges. In a text with characters the splitting rule is not written out for, the same
    holds for a word and the single space before it; where white space meets white space there, the tokenizer gets
    the whole text, as it does where a text holds the content of one of the file's added tokens.
    """

    def build():
        if path is None:
            import public_tokenizers
        return _Encoder(path or public_tokenizers.path("byte_bpe_50k.json"))

    return build


def _blocks(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows of (id, text), few enough for their texts to have BLOCK characters or to be one text."""
    block, size = [], 0
    for doc_id, text in rows:
        text = text or ""
        if block and (size + len(text) > BLOCK or len(block) >= BLOCK_TEXTS):
            yield block
            block, size = [], 0
        block.append((doc_id, text))
        size += len(text)
    if block:
        yield block


def tokenized(docs: DataFrame, encoder=None, end_id: int = END_ID) -> DataFrame:
    """One row per document: part, local (tokens before it in its partition), n_tokens, doc_id, ids."""
    build = encoder or byte_bpe()

    def run(rows):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        encode, part, local = build(), TaskContext.get().partitionId(), 0
        many = getattr(encode, "many", None) or (lambda texts: map(encode, texts))
        end = np.array([end_id], "<u2").tobytes()
        for block in _blocks(rows):
            for (doc_id, _), ids in zip(block, many([text for _, text in block])):
                ids += end
                n = len(ids) // 2
                yield part, local, n, doc_id, ids
                local += n

    fields = [("part", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("doc_id", pa.int64()),
              ("ids", pa.binary())]
    return map_rows(docs.select("doc_id", "text"), run, fields, 128)


def pieces(docs: DataFrame, window: int = WINDOW, encoder=None, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids (16-bit), ids_crc32, doc_tokens, sequence_id, offset; one row per piece."""
    stored = written(tokenized(docs, encoder, end_id), "packing")
    totals = stored.groupBy("part").agg(F.max(F.col("local") + F.col("n_tokens")).alias("total"))
    # One row per partition of the input: the only global order is over these.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("part").alias("base_part"),
                          F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = stored.join(F.broadcast(bases), stored["part"] == bases["base_part"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("at"), "ids")

    def cut(rows):
        for doc_id, at, raw in rows:
            ids = np.frombuffer(raw, "<u2")
            n, start = len(ids), 0
            while start < n:
                here = at + start
                length = min(n - start, window - here % window)
                piece = ids[start:start + length]
                yield (doc_id, start, length, piece.tobytes(), zlib.crc32(piece.astype("<u4").tobytes()), n,
                       here // window, here % window)
                start += length

    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
              ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
              ("offset", pa.int64())]
    return map_rows(placed, cut, fields)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens and the token ids of every packed sequence, padded to ``window``.

    A sequence whose length is a power of two stays unpadded. A group holds one window of tokens at most.
    """
    each = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    def join(rows):
        for sequence_id, n, parts in rows:
            ids = np.frombuffer(b"".join(p["ids"] for p in parts), "<u2").astype(np.int64)
            pad = 0 if n & (n - 1) == 0 else window - n
            yield sequence_id, n, np.concatenate([ids, np.full(pad, pad_id, np.int64)]).tolist()

    return map_rows(each, join, [("sequence_id", pa.int64()), ("n_tokens", pa.int64()),
                                 ("ids", pa.list_(pa.int64()))])
