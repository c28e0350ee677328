"""Document fingerprints: a digest of which hashed byte triplets are frequent in a text.

All byte triplets inside a sliding window of four bytes are hashed into 128 buckets. The three quartiles of
the bucket counts turn each count into two bits; the digest is the text's length class and those 256 bits in
hexadecimal. Two digests differ by their bucket codes (0, 1, 2, or 6 for opposite ends) and their length
classes; the sum is bounded and turned into a likeness from 0 to 1.

Cases: null and empty texts have the digest of no triplets; equal texts have equal digests; texts are counted
block by block, whatever their length. In the order of the documents, null ids come last and equal ids are
ordered by text; repeated rows are documents of their own; the document after the last is the first (itself,
in a table of one); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import map_rows

BUCKETS = 128
#: The difference from which digests count as wholly unlike: about that of independent codes.
BOUND = 208
LENGTH_WEIGHT = 2
LENGTH_MOST = 12
_BLOCK = 1 << 20
_MUL = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
_STEP = np.array([0, 1, 2, 6])


def bucket_counts(raw: bytes) -> np.ndarray:
    """Number of byte triplets per bucket: of each byte, the pairs among the three that follow it."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(raw) - 2, 0), _BLOCK):
        d = np.frombuffer(raw, np.uint8, min(_BLOCK + 3, len(raw) - at), at).astype(np.uint32)
        whole = at + _BLOCK + 3 > len(raw)
        for salt, (i, j) in enumerate(((1, 2), (1, 3), (2, 3))):
            n = len(d) - j
            if not whole:
                n = min(n, _BLOCK)
            if n <= 0:
                continue
            key = (d[:n] << 16) | (d[i:i + n] << 8) | d[j:j + n]
            slot = ((key + np.uint32(salt << 24)) * _MUL[salt]) >> np.uint32(25)
            total += np.bincount(slot, minlength=BUCKETS)
    return total


def length_class(n_bytes: int) -> int:
    """Steps of an eighth in length, 255 at most."""
    return min(255, round(math.log(n_bytes + 1) / math.log(1.125)))


def digest(text: str | None) -> str:
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = bucket_counts(raw)
    q = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, None] > q[None]).sum(axis=1).reshape(-1, 4)
    packed = (codes << np.array([6, 4, 2, 0])).sum(axis=1).astype(np.uint8)
    return f"{length_class(len(raw)):02x}{packed.tobytes().hex()}"


def difference(a: str, b: str) -> int:
    """Bounded difference of two digests, 0 to BOUND."""
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    length = min(abs(int(x[0]) - int(y[0])), LENGTH_MOST) * LENGTH_WEIGHT
    shifts = np.array([[6], [4], [2], [0]], np.uint8)
    codes = np.abs(((x[1:] >> shifts) & 3).astype(np.int64) - ((y[1:] >> shifts) & 3))
    return int(min(BOUND, length + _STEP[codes].sum()))


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / BOUND


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and digest of every row."""
    def run(rows):
        for doc_id, text in rows:
            yield doc_id, digest(text)

    return map_rows(docs.select("doc_id", "text"), run, [("doc_id", pa.int64()), ("fingerprint", pa.string())])


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the following text, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """range_no, tail, doc_id, text sorted so that each document's follower is the next row of its partition.

    Ids are cut into ranges at approximate quantiles (one bound per range reaches the driver). The first
    document of each range is also sent, marked as tail, to the range before it, so texts move once.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", "text")
    n = ranges or max(1, base.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    steps = [k / n for k in range(1, n)]
    cuts = base.agg(F.percentile_approx("doc_id", steps, max(10_000, 2 * n)).alias("c")).first()["c"] if steps else None
    bounds = sorted(set(cuts or []))
    bound_list = F.lit(bounds) if bounds else F.array().cast("array<bigint>")
    # Null ids sort behind every other one and go to a range of their own.
    range_no = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(
        F.size(F.filter(bound_list, lambda b: b <= F.col("doc_id")))).cast("int")
    ranged = base.withColumn("range_no", range_no)
    firsts = ranged.groupBy("range_no").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
                                            .alias("f")).orderBy("range_no").collect()
    if not firsts:
        return ranged.select("range_no", F.lit(False).alias("tail"), "doc_id", "text")
    # One row per range: which range gets a copy of each range's first id.
    before = {r["range_no"]: firsts[k - 1]["range_no"] for k, r in enumerate(firsts)}
    first = {r["range_no"]: r["f"]["doc_id"] for r in firsts}
    where = spark.createDataFrame([(r, before[r], first[r]) for r in before],
                                  "of_range int, to_range int, first_id bigint")
    tagged = ranged.join(F.broadcast(where), F.col("range_no") == F.col("of_range"))
    copies = F.when(F.col("doc_id").eqNullSafe(F.col("first_id")),
                    F.array(F.struct(F.col("range_no").alias("r"), F.lit(False).alias("t")),
                            F.struct(F.col("to_range").alias("r"), F.lit(True).alias("t")))
                    ).otherwise(F.array(F.struct(F.col("range_no").alias("r"), F.lit(False).alias("t"))))
    spread = tagged.select(F.explode(copies).alias("x"), "doc_id", "text").select(
        F.col("x.r").alias("range_no"), F.col("x.t").alias("tail"), "doc_id", "text")
    return spread.repartition(n, "range_no").sortWithinPartitions(
        "range_no", "tail", F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())


def compare_with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per document its digest, that of its edited text, and its likeness to that and to the next document."""
    def run(rows):
        held = None  # the document that waits for its follower

        def result(one, other):
            doc_id, text, mark = one
            changed = edited(text, other[1])
            changed_mark = digest(changed)
            return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), mark,
                    changed_mark, likeness(mark, changed_mark), likeness(mark, other[2]))

        closed = None  # range whose first tail has been used
        current = None
        for range_no, tail, doc_id, text in rows:
            if range_no != current:
                current, held = range_no, None
            if tail and closed == range_no:
                continue
            row = (doc_id, text or "", digest(text))
            if held:
                yield result(held, row)
            held = row
            if tail:
                closed, held = range_no, None

    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
              ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
              ("near_next", pa.float64())]
    return map_rows(with_next(docs, ranges), run, fields)
