"""Helpers the operators share: row-wise Arrow maps, written intermediates, word and shingle hashes.

Word hashes are 64-bit and position independent, computed for a whole text with numpy: a word is cut into lanes of
eight bytes, each lane is mixed with its number, and the mixed lanes are summed with the length and mixed again. (A
polynomial of the bytes modulo a power of two would not do: words of Thue-Morse form collide under every base.)
Words are maximal runs outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; all work is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import weakref
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tickwise
from tickwise.config import scratch_path
from tickwise.sources.fs import delete_path

_DDL = {pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.string(): "string",
        pa.binary(): "binary", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<bigint>",
        pa.list_(pa.float64()): "array<double>"}


_SHIPPED: set[str] = set()
#: Rows in an Arrow batch between Spark and a Python worker. Both sides hold a whole batch of texts, or two.
ARROW_ROWS = 512


def ship(spark: SparkSession) -> None:
    """Ready a session for this package's Python tasks: small Arrow batches, and the package sent to the executors'
    workers, once per application, since they need not have it installed."""
    bound_batches(spark)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(tickwise.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tickwise-code-")) / "tickwise.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in package.rglob("*.py"):
            out.write(source, Path(package.name) / source.relative_to(package))
    context.addPyFile(str(archive))


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch hold more than ``ARROW_ROWS`` rows: Spark's 10,000 are tens of MB of texts a task, in the JVM
    as well as in Python. A smaller number set by the caller stays."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterable[tuple]], fields: list[tuple[str, pa.DataType]],
             rows_per_batch: int = 512) -> DataFrame:
    """``fn`` gets the rows of one partition as tuples, in order, and yields result tuples.

    Only a slice of 128 rows is turned into Python objects at a time and results leave in small batches,
    so a task's memory is bounded by one Arrow batch and not by the partition.
    """
    schema = pa.schema(fields)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 128):
                    part = batch.slice(at, 128)
                    yield from zip(*(c.to_pylist() for c in part.columns))

        held: list[tuple] = []
        for row in fn(rows()):
            held.append(row)
            if len(held) >= rows_per_batch:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return df.mapInArrow(run, ", ".join(f"`{n}` {_DDL[t]}" for n, t in fields))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared scratch folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PLACES[id(out)] = (weakref.ref(out, lambda _, key=id(out): _PLACES.pop(key, None)), path)
    return out


#: Where the tables made by ``written`` lie, by the frame that reads them.
_PLACES: dict[int, tuple] = {}


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written`, once everything that reads them has been written itself."""
    for table in tables:
        found = _PLACES.pop(id(table), None)
        if found is not None:
            delete_path(table.sparkSession, found[1])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 4; fold 2 is held out from learning. Null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


# ---- word and shingle hashes ---------------------------------------------------------------------------

SEGMENT = 1 << 20
_M = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_HELD = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LANE = mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(_R))  # what is added to a lane by its number


def _hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """uint64 hash of the words raw[start:end], all of them non-empty; ``raw`` ends with eight bytes to spare."""
    size = ends - starts
    lanes = (size + 7) >> 3
    first = np.cumsum(lanes) - lanes
    word = np.repeat(np.arange(len(starts)), lanes)
    number = np.arange(len(word)) - first[word]
    at = starts[word] + 8 * number
    lane = np.lib.stride_tricks.sliding_window_view(raw, 8)[at].view("<u8").ravel()
    held = np.minimum(size[word] - 8 * number, 8)  # bytes of the lane that are the word's
    lane &= _HELD[held]
    lane = mix(lane + _LANE[np.minimum(number, len(_LANE) - 1)] + number.astype(np.uint64))
    return mix(np.add.reduceat(lane, first) + size.astype(np.uint64) * np.uint64(_R))


def _segments(data: bytes) -> Iterator[bytes]:
    """Pieces of at most SEGMENT bytes cut before white space; a longer word is a piece of its own."""
    at, n = 0, len(data)
    while n - at > SEGMENT:
        window = data[at:at + SEGMENT]
        cut = max(window.rfind(g) for g in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut > 0:
            yield window[:cut]
            at += cut
        else:
            gap = _GAP.search(data, at + 1)
            end = gap.start() if gap else n
            yield data[at:end]
            at = end
    yield data[at:]


def word_hashes(text: str | None) -> np.ndarray:
    """uint64 hash per word of the whole text, in order."""
    data = (text or "").encode("utf-8", "surrogatepass")
    found = []
    for piece in _segments(data):
        if len(piece) > SEGMENT:
            word = piece.lower().strip()
            found.append(np.array([int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")], np.uint64))
            continue
        raw = _LOWER[np.frombuffer(piece + bytes(8), np.uint8)]
        gap = _SPACE[raw[:-8]]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
        if len(edge):
            found.append(_hashed(raw, edge[0::2], edge[1::2]))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """63-bit hash (as uint64) per run of ``width`` words, so that signed and unsigned order agree.

    A shorter text has its whole sequence as one run; a text without words has none.
    """
    n = len(words)
    if not n:
        return words
    if n < width:
        acc = np.array([n], np.uint64)
        for j in range(n):
            acc = mix(acc * np.uint64(_R) + words[j:j + 1])
        return acc >> np.uint64(1)
    acc = words[:n - width + 1]
    for j in range(1, width):
        acc = mix(acc * np.uint64(_R) + words[j:n - width + 1 + j])
    return acc >> np.uint64(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The text's distinct shingles, sorted."""
    return np.unique(shingle_hashes(word_hashes(text), width))


def longs(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()
