"""Embedding whitening with exact integer statistics from bit-sliced cross-products.

Each entry ``c`` becomes the integer ``x = floor(64 c) + 1000000``. The fit list holds every distinct x vector once.
A task takes its part of the list in blocks, shifts every dimension by its least value, and packs each bit of each
dimension across the block's rows into machine words (a bit plane). The AND of two planes has as many ones as there
are rows with both bits set, so the weighted sum of those counts is the exact cross-product of two dimensions, and
the counts of a plane with itself give the sums. Counts of all tasks are added as integers; ``n * cross - sum * sum``
centres them exactly before anything becomes a floating-point number, so the covariance carries one rounding only.
It has a row per dimension, not per vector, and its eigenvectors are found on the driver.

Cases: rows whose vector is null or holds null, NaN or infinite entries are left out; so are vectors of another
length than most of the others have (of equally many the longer); scaled entries are held within +-2^62; repeated
vectors count once in the fit and each row has its result; a null vec_id is kept; components without variance (a
constant or dependent dimension, a single vector) cannot be whitened and are not returned, so a table with one
distinct vector, like an empty table, gives no rows; a deviation beyond 2^63 is null; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import ship, written

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Rows whose bits are packed at a time.
BLOCK = 4096
_EDGE = 1 << 62
_LIMB = 45  # bits of a summed limb: sums over a quarter of a million tasks stay within a long
_LIMBS = 4
_WIDTHS = ((1, np.int8), (2, np.int16), (4, np.int32), (8, np.int64))


def _entries(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the rows that remain, their entries as doubles) of a list column."""
    at = np.flatnonzero(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == dims)
    flat = column.take(pa.array(at)).flatten()
    entries = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dims)
    whole = np.isfinite(entries).all(axis=1)
    return at[whole], entries[whole]


def _scaled(entries: np.ndarray) -> np.ndarray:
    """floor(64 c) as integers."""
    return np.clip(np.floor(entries * SCALE), -float(_EDGE), float(_EDGE)).astype(np.int64)


def pack(q: np.ndarray) -> list[bytes]:
    """One byte string per row, equal for equal rows only: the narrowest integers that hold the row."""
    high = np.maximum(q.max(axis=1), ~q.min(axis=1))
    out: list[bytes | None] = [None] * len(q)
    low = -1
    for width, kind in _WIDTHS:
        top = np.iinfo(kind).max
        rows = np.flatnonzero((high > low) & (high <= top))
        low = top
        for i, row in zip(rows.tolist(), q[rows].astype(kind)):
            out[i] = row.tobytes()
    return out


def unpack(packed: list[bytes], dims: int) -> np.ndarray:
    q = np.empty((len(packed), dims), np.int64)
    size = np.array([len(p) // dims for p in packed])
    for width, kind in _WIDTHS:
        rows = np.flatnonzero(size == width)
        if len(rows):
            q[rows] = np.frombuffer(b"".join(packed[i] for i in rows), kind).reshape(-1, dims)
    return q


def _map(df: DataFrame, fn, fields: list[tuple[str, pa.DataType]], ddl: str) -> DataFrame:
    """``fn`` gets an iterator of record batches and yields lists of columns."""
    schema = pa.schema(fields)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return df.mapInArrow(run, ddl)


def dimensions(vectors: DataFrame, column: str = "embedding") -> int | None:
    """The length that most vectors without null or non-finite entries have; None if there is none."""
    c = F.col(column)
    sound = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    most = vectors.where(c.isNotNull() & (F.size(c) > 0) & sound).groupBy(F.size(c).alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).first()
    return most["d"] if most else None


def fit_list(vectors: DataFrame, dims: int, column: str = "embedding") -> DataFrame:
    """Every distinct scaled vector once, packed; equal vectors meet in partial aggregates before the shuffle."""
    def run(batches):
        for batch in batches:
            packed = pack(_scaled(_entries(batch.column(0), dims)[1])) if batch.num_rows else []
            if packed:
                yield [packed]

    each = _map(vectors.select(column), run, [("x", pa.binary())], "x binary")
    return written(each.distinct(), "whitening-fit")


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield unpack(batch.column(0).slice(at, BLOCK).to_pylist(), dims)


def _ranges(fit: DataFrame, dims: int) -> tuple[list[int], list[int]]:
    """Least and largest value of each dimension."""
    def run(batches):
        low, high = None, None
        for q in _blocks(batches, dims):
            low = q.min(axis=0) if low is None else np.minimum(low, q.min(axis=0))
            high = q.max(axis=0) if high is None else np.maximum(high, q.max(axis=0))
        if low is not None:
            yield [list(range(dims)), low.tolist(), high.tolist()]

    fields = [("dim", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]
    each = _map(fit, run, fields, "dim int, low bigint, high bigint").groupBy("dim").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()  # a row per dimension
    return [r["low"] for r in each], [r["high"] for r in each]


def bit_planes(y: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(planes, first plane of each dimension) of the non-negative block ``y``; dimension d has ``bits[d]`` planes."""
    first = np.concatenate(([0], np.cumsum(bits))).astype(np.int64)
    planes = np.zeros((first[-1], -(-len(y) // 64) * 8), np.uint8)
    wide = np.array(bits)
    for bit in range(max(bits, default=0)):
        dims = np.flatnonzero(wide > bit)
        packed = np.packbits(((y[:, dims] >> bit) & 1).astype(np.uint8).T, axis=1)
        planes[first[dims] + bit, :packed.shape[1]] = packed
    return planes.view(np.uint64), first


def cross_products(y: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(cross-products of dimensions i <= j, sums) of the block, from weighted counts of the ones that planes share.

    The integers are of 64 bits where they provably fit, else Python's.
    """
    planes, first = bit_planes(y, bits)
    kind = np.int64 if 2 * max(bits, default=0) + BLOCK.bit_length() < 63 else object
    weight = np.array([1 << bit for n in bits for bit in range(n)], kind)
    dims = len(bits)
    cross, sums = np.zeros((dims, dims), kind), np.zeros(dims, kind)
    filled = np.flatnonzero(np.array(bits) > 0)
    for i in filled.tolist():
        at = int(first[i])
        later = filled[filled >= i]
        for bit in range(bits[i]):
            ones = np.bitwise_count(planes[at + bit] & planes[at:]).sum(axis=1, dtype=np.int64).astype(kind)
            cross[i, later] += np.add.reduceat(ones * weight[at:], first[later] - at) << bit
            sums[i] += int(ones[bit]) << bit
    return cross, sums


def _limbs(value: int) -> list[int]:
    return [(value >> (_LIMB * k)) & ((1 << _LIMB) - 1) for k in range(_LIMBS)]


def scatter(fit: DataFrame, dims: int, low: list[int], high: list[int]) -> tuple[int, list[int], list[list[int]]]:
    """(rows, sums, cross-products) of the fit list shifted by ``low``, all exact."""
    base = np.array(low, np.int64)
    bits = [int(h - x).bit_length() for x, h in zip(low, high)]

    room = (1 << 62) >> (2 * max(bits, default=0))  # rows whose cross-products surely fit a long

    def run(batches):
        n, held, cross, sums, whole = 0, 0, 0, 0, None
        for q in _blocks(batches, dims):
            c, s = cross_products(q - base, bits)
            if whole is None or held + len(q) > room:  # carry the longs over into Python's integers
                whole = [w + x.astype(object) for w, x in zip(whole, (cross, sums))] if whole else [0, 0]
                cross, sums, held = c, s, len(q)
            else:
                cross, sums, held = cross + c, sums + s, held + len(q)
            n += len(q)
        if n:
            cross, sums = (w + x.astype(object) for w, x in zip(whole, (cross, sums)))
            cells = [(i, j, cross[i, j]) for i in range(dims) for j in range(i, dims)]
            cells += [(i, -1, s) for i, s in enumerate(sums)] + [(-1, -1, n)]
            yield [*zip(*((i, j, *_limbs(int(v))) for i, j, v in cells))]

    limbs = [f"l{k}" for k in range(_LIMBS)]
    fields = [("i", pa.int32()), ("j", pa.int32()), *((k, pa.int64()) for k in limbs)]
    ddl = "i int, j int, " + ", ".join(f"{k} bigint" for k in limbs)
    added = _map(fit, run, fields, ddl).groupBy("i", "j").agg(*[F.sum(k).alias(k) for k in limbs]).collect()
    n, sums, cross = 0, [0] * dims, [[0] * dims for _ in range(dims)]
    for r in added:  # a row per pair of dimensions
        value = sum(r[k] << (_LIMB * p) for p, k in enumerate(limbs))
        if r["i"] < 0:
            n = value
        elif r["j"] < 0:
            sums[r["i"]] = value
        else:
            cross[r["i"]][r["j"]] = cross[r["j"]][r["i"]] = value
    return n, sums, cross


@dataclass(frozen=True)
class Whitening:
    """A fitted transform. Vectors are shifted by ``low`` first; ``n`` and ``sums`` are those of the fit list."""

    dims: int
    n: int
    low: list[int]
    sums: list[int]
    values: list[float]
    explained: list[float]
    axes: np.ndarray  # a row per component: unit eigenvector over the root of its eigenvalue

    def centred(self, q: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """(x - mean as doubles, exact sum of the squared n * (x - mean) per row) of scaled vectors."""
        y = q - np.array(self.low, np.int64)
        top = int(y.max(initial=0))
        if self.n * max(top, max(self.sums, default=0) // max(self.n, 1) + 1) < _EDGE:
            off = y * self.n - np.array(self.sums, np.int64)
            large = int(np.abs(off).max(initial=0))
            exact = (off * off).sum(axis=1) if large * large * max(self.dims, 1) < _EDGE else [
                sum(v * v for v in row) for row in off.tolist()]
        else:
            off = y.astype(object) * self.n - np.array(self.sums, object)
            exact = [sum(v * v for v in row) for row in off.tolist()]
        deviation = [int(v) if v < 1 << 63 else None for v in exact]
        return (off / self.n).astype(np.float64), deviation

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.axes.T


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame | None]:
    """(the transform, the fit list it was made from); None where no row has a sound vector."""
    dims = dimensions(vectors, column)
    if dims is None:
        return None, None
    listed = fit_list(vectors, dims, column)
    low, high = _ranges(listed, dims)
    n, sums, cross = scatter(listed, dims, low, high)
    covariance = np.array([[float(n * cross[i][j] - sums[i] * sums[j]) for j in range(dims)] for i in range(dims)])
    covariance /= float(n) * float(n)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1].T
    total = float(np.trace(covariance))
    kept = min(components, int((values > max(values[0], 0.0) * dims * np.finfo(np.float64).eps).sum()))
    values, axes = values[:kept], axes[:kept]
    if kept:  # the sign is free: the largest entry of a component is positive
        lead = np.abs(axes).argmax(axis=1)
        axes = axes * np.sign(axes[np.arange(kept), lead])[:, None]
    return Whitening(dims, n, low, sums, values.tolist(), [float(v) / total for v in values],
                     axes / np.sqrt(values)[:, None]), listed


def identity_error(transform: Whitening, listed: DataFrame) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    size = len(transform.values)
    shared = listed.sparkSession.sparkContext.broadcast(transform)  # a number per dimension and component

    def run(batches):
        t, total, moved = shared.value, np.zeros((size, size)), np.zeros(size)
        for q in _blocks(batches, t.dims):
            w = t.project(t.centred(q)[0])
            total += w.T @ w
            moved += w.sum(axis=0)
        yield [*zip(*[(i, j, total[i, j]) for i in range(size) for j in range(size)], *[(i, -1, moved[i]) for i in range(size)])]

    fields = [("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())]
    found = {(r["i"], r["j"]): r["s"] for r in _map(listed, run, fields, "i int, j int, s double")
             .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}  # a row per pair of components
    mean = np.array([found[i, -1] for i in range(size)]) / transform.n
    second = np.array([[found[i, j] for j in range(size)] for i in range(size)]) / transform.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, transform: Whitening, column: str = "embedding") -> DataFrame:
    """vec_id, deviation, whitened (array, one entry per component) of every row with a sound vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(transform)

    def run(batches):
        t = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                at, entries = _entries(part.column(1), t.dims)
                if len(at):
                    centred, deviation = t.centred(_scaled(entries))
                    yield [part.column(0).take(pa.array(at)), deviation, list(t.project(centred))]

    fields = [("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))]
    return _map(vectors.select(F.col("vec_id").cast("bigint"), column), run, fields,
                "vec_id bigint, deviation bigint, whitened array<double>")


def components_of(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per sound vector and component."""
    transform, listed = fit(vectors, column, components)
    if transform is None or not transform.values:
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, "
                                                    "whitened double, explained double, identity_error double")
    error = identity_error(transform, listed)
    share = F.array(*[F.lit(v) for v in transform.explained])
    return whiten(vectors, transform, column).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(transform.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.element_at(share, F.col("place") + 1).alias("explained"), F.lit(error).alias("identity_error"))
