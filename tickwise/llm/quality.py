"""Quality classifier: kernel ridge regression on document statistics by random Fourier features.

Every text becomes a short vector of statistics of the whole text. Random Fourier features approximate a
Gaussian kernel over the standardised vector; the normal equations of a ridge regression are summed per
partition and then over partitions; isotonic regression on rows the ridge has not seen turns its output into
a probability.

Cases: null and empty texts have all-zero statistics and are scored like any other; labels of unknown
documents, null labels and null ids teach nothing; a document with contradicting labels counts with each;
repeated rows are scored each; without any usable label every score is 0.5, with labels of one kind the
share of that kind; an empty table gives an empty result. Labels, language, source and id never enter a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import fold, held_out, map_rows, word_hashes, written

#: Bound of the labelled sample (expected rows, chosen by a hash of the id) and shape of the model.
MAX_LABELLED = 50_000
FEATURES = 192
RIDGE = 1e-3
THRESHOLD = 0.7
SUM_TASKS = 8
BINS = 2048
SEED = 11

_CLASS = np.zeros(256, np.int64)  # 0 other symbols, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 . , 7 beyond ASCII
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
_CLASS[[44, 46, 59, 58, 39, 45]] = 6
_CLASS[128:] = 7
N_STATISTICS = 24


def statistics(text: str | None) -> list[float]:
    """Length, character classes, word shapes and repetition of the whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * N_STATISTICS
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=counts, minlength=8)
    n = len(raw)
    share = counts[counts > 0] / n
    words = word_hashes(text)
    w = len(words)
    lines = [x for x in raw.split(b"\n") if x]
    out = [np.log1p(n), np.log1p(w), *(kinds / n), float(-(share * np.log2(share)).sum()), float(share.max())]
    if w:
        _, each = np.unique(words, return_counts=True)
        each.sort()
        pairs = words[1:] * np.uint64(3) ^ words[:-1]
        distinct_pairs = len(np.unique(pairs)) / max(1, len(pairs))
        out += [n / w, len(each) / w, each[-1] / w, each[-10:].sum() / w, len(each) / np.sqrt(w), distinct_pairs,
                float((words[1:] == words[:-1]).mean()) if w > 1 else 0.0]
    else:
        out += [0.0] * 7
    upper = sum(x.isupper() for x in raw.split()) / max(1, w)
    distinct_lines = len(set(lines)) / max(1, len(lines))
    longest = max((len(x) for x in lines), default=0)
    out += [upper, distinct_lines, len(lines) / max(1, w), np.log1p(longest), (raw.count(b".") + raw.count(b"!")) / max(1, w)]
    return [float(x) for x in out]


def statistics_table(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every row: a small written table that every later step reads."""
    def run(rows):
        for doc_id, text in rows:
            yield doc_id, statistics(text)

    fields = [("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))]
    return written(map_rows(docs.select("doc_id", "text"), run, fields, 4096), "quality")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the random frequencies
    phase: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Standardised statistics, their random Fourier features, and a constant."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2.0 / len(self.phase)) * np.cos(z @ self.weights + self.phase)
        return np.concatenate([waves, z / 10, np.ones((len(z), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def isotonic(x: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points in order of ``x``: (knots, levels) of the rising step line."""
    blocks: list[list[float]] = []  # level, weight, first x, last x
    for at, w, m in zip(x, weight, mean):
        blocks.append([m, w, at, at])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _, last = blocks.pop()
            m1, w1, first, _ = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, first, last])
    knots = [v for b in blocks for v in b[2:4]]
    levels = [b[0] for b in blocks for _ in range(2)]
    return np.array(knots), np.array(levels)


def _constant(p: float) -> Model:
    one = np.zeros(1)
    return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), np.zeros((N_STATISTICS, 1)), one,
                 np.zeros(N_STATISTICS + 2), np.zeros(1), np.array([p]))


def fit(table: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, features: int = FEATURES,
        ridge: float = RIDGE) -> Model:
    """Ridge on folds 0 and 1, calibration on fold 3; fold 2 is never read."""
    target = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("y")).where(
        F.col("y").isin(0.0, 1.0) & (fold(F.col("label_id")) != 2))
    share = min(1.0, max_labelled / max(1, target.count()))
    draw = F.pmod(F.xxhash64("label_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    target = target.where(draw < share)
    # The sample is small by its bound; a plain join lets Spark choose by its real size.
    learn = written(table.join(target, table["doc_id"] == target["label_id"])
                    .select("x", "y", (fold(F.col("doc_id")) == 3).alias("later")), "quality-learn")
    totals = {r["y"]: r["n"] for r in learn.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return _constant(next(iter(totals), 0.5))
    columns = [F.col("x")[k] for k in range(N_STATISTICS)]
    moments = learn.agg(*(F.avg(c) for c in columns), *(F.stddev_pop(c) for c in columns)).first()
    mean, sd = np.array(moments[:N_STATISTICS]), np.array(moments[N_STATISTICS:])
    rng = np.random.Generator(np.random.PCG64(SEED))
    model = Model(mean, np.where(sd > 1e-9, sd, 1.0), rng.standard_normal((N_STATISTICS, features)) / np.sqrt(N_STATISTICS),
                  rng.uniform(0, 2 * np.pi, features), np.zeros(0), np.zeros(0), np.zeros(0))
    folds = learn.where(~F.col("later"))
    if folds.limit(1).count() == 0 or learn.where("later").limit(1).count() == 0:
        folds, rest = learn, learn  # too few rows for separate folds
    else:
        rest = learn.where("later")

    def sums(rows):
        total, size = None, 0
        held: list[tuple] = []

        def add():
            nonlocal total
            phi = model.expand(np.array([x for x, _ in held]))
            y = np.array([v for _, v in held])
            both = np.concatenate([phi, y[:, None]], axis=1)
            part = both.T @ both
            total = part if total is None else total + part

        for x, y in rows:
            held.append((x, y))
            size += 1
            if len(held) == 2048:
                add()
                held = []
        if held:
            add()
        if total is not None:
            yield total.tobytes(), size

    # A fixed few tasks sum their rows: what reaches the driver is one square matrix from each.
    parts = map_rows(folds.select("x", "y").coalesce(SUM_TASKS), sums, [("m", pa.binary()), ("n", pa.int64())]).collect()
    width = features + N_STATISTICS + 2
    total = sum(np.frombuffer(r["m"]).reshape(width, width) for r in parts)
    count = sum(r["n"] for r in parts)
    a, b = total[:-1, :-1], total[:-1, -1]
    model.beta = np.linalg.solve(a + ridge * count / features * np.eye(width - 1), b)

    def scored(rows):
        held = list(rows)
        if held:
            raw = model.raw(np.array([x for x, _ in held]))
            yield from zip(raw.tolist(), (y for _, y in held))

    # Calibration points: a fixed grid over the ridge output, one row per filled cell.
    cell = F.floor((F.least(F.greatest(F.col("s"), F.lit(-0.5)), F.lit(1.5)) + 0.5) * (BINS / 2))
    points = (map_rows(rest.select("x", "y"), scored, [("s", pa.float64()), ("y", pa.float64())])
              .groupBy(cell.alias("cell")).agg(F.avg("s").alias("s"), F.count("*").alias("n"), F.avg("y").alias("y"))
              .orderBy("cell").collect())
    model.knots, model.levels = isotonic(*(np.array([r[k] for r in points], float) for k in ("s", "n", "y")))
    return model


def score(table: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of a statistics table."""
    def run(rows):
        held: list[tuple] = []

        def out():
            found = np.clip(model.score(np.array([x for _, _, x in held])), 0.0, 1.0)
            for (doc_id, out_fold, _), s in zip(held, found.tolist()):
                yield doc_id, out_fold, s, int(s >= threshold)

        for row in rows:
            held.append(row)
            if len(held) == 2048:
                yield from out()
                held = []
        if held:
            yield from out()

    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
    return map_rows(table.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "x"), run, fields, 4096)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    table = statistics_table(docs)
    return score(table, fit(table, labels))
