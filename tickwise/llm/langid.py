"""Language identification by prediction by partial matching over byte contexts.

Per language the bytes after every context of 3, 2, 1 and 0 bytes are counted once and then frozen. A byte
costs the bits an arithmetic coder would spend: in the longest context known to the language, count/(total +
distinct) if the byte was seen there (escape method C), else the escape probability distinct/(total +
distinct) and on to the next shorter context, down to a uniform byte. The language with the shortest code wins.

Cases: null or letterless text (empty included) is ``und`` with score 0; a null id counts as not held out
but is never learned from; ties between languages go to the first in code-point order; repeated rows are
scored (and counted) as often as they occur; an empty table, or one without any learnable row, gives no
model and every text ``und``. Input columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import fold, held_out, map_rows, ship

#: Bound of the learning sample: expected bytes of text per language, rows chosen by a hash of their id.
TRAIN_BYTES = 1_000_000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_ORDER = 3
_BLOCK = 1 << 18


def _grams(data: np.ndarray) -> np.ndarray:
    """uint32 of each byte and the three before it; ``data`` starts with three zero bytes of padding."""
    d = data.astype(np.uint32)
    return (d[:-3] << 24) | (d[1:-2] << 16) | (d[2:-1] << 8) | d[3:]


def _padded(raw: bytes) -> np.ndarray:
    return np.frombuffer(b"\0" * _ORDER + raw, np.uint8)


def _encode(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


@dataclass
class Model:
    """Code lengths in bits for every known context; rows follow sorted gram keys, columns the languages."""

    languages: list[str]
    keys4: np.ndarray
    bits4: np.ndarray
    keys3: np.ndarray
    bits3: np.ndarray
    escape3: np.ndarray
    escape2: np.ndarray
    bits2: np.ndarray

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """Bits per gram (its last byte after the first three) and language."""
        at = np.searchsorted(self.keys4, grams)
        np.minimum(at, len(self.keys4) - 1, out=at)
        out = self.bits4[at]
        miss = np.flatnonzero(self.keys4[at] != grams)
        if len(miss):
            g = grams[miss]
            out[miss] = self._escape(g >> np.uint32(8)) + self._three(g & np.uint32(0xFFFFFF))
        return out

    def _find3(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys3, grams), len(self.keys3) - 1)
        return at, self.keys3[at] == grams

    def _escape(self, context: np.ndarray) -> np.ndarray:
        at, known = self._find3(context)
        return np.where(known[:, None], self.escape3[at], np.float32(0))

    def _three(self, grams: np.ndarray) -> np.ndarray:
        at, known = self._find3(grams)
        return np.where(known[:, None], self.bits3[at],
                        self.escape2[grams >> np.uint32(8)] + self.bits2[grams & np.uint32(0xFFFF)])

    def text_bits(self, raws: list[bytes]) -> np.ndarray:
        """Total bits per text and language. Texts are non-empty; long ones are read block by block."""
        out = np.zeros((len(raws), len(self.languages)))
        group: list[int] = []
        size = 0
        for i, raw in enumerate(raws):
            if len(raw) > _BLOCK:
                for at in range(0, len(raw), _BLOCK):
                    lead = raw[max(0, at - _ORDER):at].rjust(_ORDER, b"\0")
                    block = np.frombuffer(lead + raw[at:at + _BLOCK], np.uint8)
                    out[i] += self.costs(_grams(block)).sum(axis=0, dtype=np.float64)
                continue
            group.append(i)
            size += len(raw)
            if size >= _BLOCK:
                self._together(raws, group, out)
                group, size = [], 0
        if group:
            self._together(raws, group, out)
        return out

    def _together(self, raws: list[bytes], group: list[int], out: np.ndarray) -> None:
        grams = np.concatenate([_grams(_padded(raws[i])) for i in group])
        starts = np.cumsum([0] + [len(raws[i]) for i in group[:-1]])
        out[group] = np.add.reduceat(self.costs(grams).astype(np.float64), starts, axis=0)


def freeze(languages: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray) -> Model:
    """Code-length tables from (language index, 4-byte gram, count) rows."""
    n_lang = len(languages)
    keys4, at = np.unique(gram, return_inverse=True)
    c4 = np.zeros((len(keys4), n_lang))
    np.add.at(c4, (at, lang), count)

    # Counts of the shorter grams are sums over the dropped first bytes.
    keys3, at3 = np.unique(np.concatenate([keys4 & np.uint32(0xFFFFFF), keys4 >> np.uint32(8)]), return_inverse=True)
    tail3, head3 = at3[:len(keys4)], at3[len(keys4):]
    c3 = np.zeros((len(keys3), n_lang))
    np.add.at(c3, tail3, c4)
    c2 = np.zeros((65536, n_lang))
    np.add.at(c2, (keys3 & np.uint32(0xFFFF)).astype(np.int64), c3)
    c1 = c2.reshape(256, 256, n_lang).sum(axis=0)

    def context(counts: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        total, distinct = np.zeros((size, n_lang)), np.zeros((size, n_lang))
        np.add.at(total, of, counts)
        np.add.at(distinct, of, counts > 0)
        return total, distinct

    def coded(counts, total, distinct, shorter):
        """Bits where seen; elsewhere the escape (free where the context is unknown) and the shorter code."""
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            seen = -np.log2(counts / (total + distinct))
        return np.where(counts > 0, seen, escape + shorter)

    def escapes(total, distinct):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0).astype(np.float32)

    b1 = coded(c1, c1.sum(axis=0)[None], (c1 > 0).sum(axis=0)[None], np.full((256, n_lang), 8.0))
    first = np.arange(65536) >> 8
    t1, d1 = context(c2, first, 256)
    b2 = coded(c2, t1[first], d1[first], b1[np.arange(65536) & 255])
    pair = (keys3 >> np.uint32(8)).astype(np.int64)
    t2, d2 = context(c3, pair, 65536)
    b3 = coded(c3, t2[pair], d2[pair], b2[(keys3 & np.uint32(0xFFFF)).astype(np.int64)])
    t3, d3 = context(c4, head3, len(keys3))
    b4 = coded(c4, t3[head3], d3[head3], b3[tail3])
    return Model(languages, keys4, b4.astype(np.float32), keys3, b3.astype(np.float32), escapes(t3, d3),
                 escapes(t2, d2), b2.astype(np.float32))


def train(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> Model | None:
    """Frozen statistics from a bounded sample of the labelled rows outside the held-out fold.

    The sample holds about ``train_bytes`` bytes per language (all rows where there are fewer): rows are
    chosen by a hash of their id, so the choice is the same in every run. Only gram counts reach the driver;
    their number is bounded by the sample.
    """
    learn = docs.select("doc_id", "text", "lang").where(
        (fold(F.col("doc_id")) != 2) & F.col("lang").isNotNull() & (F.length("text") > 0))
    sizes = {r["lang"]: r["size"] for r in
             learn.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, train_bytes / sizes[k])))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = learn.where(draw < share[F.col("lang")]).select("lang", "text")

    def count(rows):
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def out():
            for lang, parts in held.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                for k, c in zip(keys.tolist(), n.tolist()):
                    yield lang, k, c

        for lang, text in rows:
            grams = _grams(_padded(_encode(text)))
            held.setdefault(lang, []).append(grams)
            size += len(grams)
            if size > 4_000_000:
                yield from out()
                held, size = {}, 0
        yield from out()

    counted = map_rows(sample, count, [("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())], 8192)
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not table.num_rows:
        return None
    index = {k: i for i, k in enumerate(languages)}
    lang = np.array([index[k] for k in table.column("lang").to_pylist()])
    return freeze(languages, lang, table.column("gram").to_numpy().astype(np.uint32),
                  table.column("n").to_numpy().astype(np.float64))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior of the chosen language), bits_per_byte of its code."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(rows):
        held: list[tuple] = []
        size = 0

        def out():
            known = [i for i, (_, _, raw) in enumerate(held) if raw]
            bits = shared.value.text_bits([held[i][2] for i in known]) if known else None
            at = dict(zip(known, range(len(known))))
            for i, (doc_id, out_fold, raw) in enumerate(held):
                if i not in at:
                    yield doc_id, out_fold, UNKNOWN, 0.0, None
                    continue
                row = bits[at[i]]
                best = int(row.argmin())
                p = 1.0 / np.exp2(np.maximum(row[best] - row, -1000.0)).sum()
                yield doc_id, out_fold, shared.value.languages[best], float(p), float(row[best] / len(raw))

        for doc_id, out_fold, text in rows:
            raw = _encode(text) if shared.value and text and _LETTER.search(text) else b""
            held.append((doc_id, out_fold, raw))
            size += len(raw)
            if size >= 1 << 20 or len(held) >= 1024:
                yield from out()
                held, size = [], 0
        yield from out()

    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
              ("bits_per_byte", pa.float64())]
    return map_rows(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), score, fields)


def identify(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    return predict(docs, train(docs, train_bytes))


#: A language explains a text of at most the bits per byte that all but a few of its labelled texts outside the
#: sample need, and MARGIN more; never more than a plain byte has. A text may take SHORT_BITS besides, whatever
#: its length: a few strange words tell nothing in a short text and little in a long one.
QUANTILE, MARGIN, MOST_BITS, SHORT_BITS = 0.999, 0.5, 8.0, 128.0


def limits(docs: DataFrame, model: Model | None) -> np.ndarray | None:
    """Bits per byte up to which each language of the model explains a text, from the labelled held-out rows."""
    if model is None:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(rows):
        known = {k: i for i, k in enumerate(shared.value.languages)}
        held: list[tuple[str, bytes]] = []
        size = 0

        def out():
            for (lang, raw), bits in zip(held, shared.value.text_bits([raw for _, raw in held])):
                yield lang, float(bits[known[lang]] / len(raw))

        for lang, text in rows:
            if lang in known and _LETTER.search(text):
                held.append((lang, _encode(text)))
                size += len(held[-1][1])
            if size >= 1 << 20 or len(held) >= 1024:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    told = docs.where((fold(F.col("doc_id")) == 2) & F.col("lang").isNotNull() & (F.length("text") > 0))
    costs = map_rows(told.select("lang", "text"), score, [("lang", pa.string()), ("bits", pa.float64())])
    found = {r["lang"]: r["q"] for r in costs.groupBy("lang").agg(F.percentile_approx("bits", QUANTILE).alias("q")).collect()}
    return np.array([min(MOST_BITS, found[k] + MARGIN) if k in found else MOST_BITS for k in model.languages])


def explained(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents some learned language explains, with their columns; judged where they lie, without a join."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model, limits(docs, model)))

    @F.pandas_udf("boolean")
    def keep(texts):
        known, most = shared.value

        def one(text) -> bool:
            if known is None or not text or not _LETTER.search(text):
                return False
            raw = _encode(text)
            return bool((known.text_bits([raw])[0] <= most * len(raw) + SHORT_BITS).any())

        return texts.map(one)

    return docs.where(keep(F.col("text")))
