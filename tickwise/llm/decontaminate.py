"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so sketches of both would hardly meet. Instead only the items are
sketched (containment MinHash): an item's sketch holds its smallest shingle hashes, and a document is asked
how many of them it contains. Items are partitioned by size; a partition's sketch length follows from its
largest item, so that a document holding the required share of an item's shingles cannot miss more sketch
hashes than the sketch has to spare: no true pair is lost. Candidates are then verified by exact containment
of the item's whole shingle set in the document's.

Equal item texts are searched for once; their ids are joined to what was found. Different texts go to the tasks in
blocks of a bounded size, every block against all documents: a block's results are written and its index released
before the next one is built, so the driver and a task hold one block at a time.

Cases: null or wordless texts on either side match nothing; an item with fewer words than a shingle counts as one
run of that many words; repeated rows give repeated result rows; null ids are kept; empty tables give an empty
result. Texts of any length are read whole. Other columns, whatever their names, are not read, and pass through
``clean`` as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import discard, map_rows, shingle_hashes, ship, word_hashes, written

WIDTH = 5
SHARE = (4, 5)
#: Bounds of one block of items: rows and bytes of text.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32 << 20
_FILTER_BITS = 1 << 22


@dataclass
class SizePartition:
    """Items of similar size and one shingle width, indexed by their sketch hashes."""

    width: int
    hashes: np.ndarray  # sorted sketch hashes
    first: np.ndarray  # postings of hash k are items[first[k]:first[k + 1]]
    items: np.ndarray
    least: np.ndarray  # sketch hashes an item's true partner holds at least


class ItemIndex:
    def __init__(self, ids: list, texts: list, width: int = WIDTH, share: tuple[int, int] = SHARE):
        self.ids, self.sets, self.need = [], [], []
        groups: dict[tuple[int, int], list[int]] = {}
        num, den = share
        for item_id, text in zip(ids, texts):
            words = word_hashes(text)
            if not len(words):
                continue
            own = min(width, len(words))
            found = np.unique(shingle_hashes(words, own))
            groups.setdefault((own, len(found).bit_length()), []).append(len(self.ids))
            self.ids.append(item_id)
            self.sets.append(found)
            self.need.append(-(-num * len(found) // den))
        self.widths = sorted({w for w, _ in groups})
        self.filter = {w: np.zeros(_FILTER_BITS, bool) for w in self.widths}
        self.parts = [self._partition(w, members) for (w, _), members in sorted(groups.items())]

    def _partition(self, width: int, members: list[int]) -> SizePartition:
        spare = max(len(self.sets[i]) - self.need[i] for i in members)
        length = 2 * spare + 4
        hashes, owners, least = [], [], np.zeros(len(self.ids), np.int64)
        for i in members:
            sketch = self.sets[i][:length]
            hashes.append(sketch)
            owners.append(np.full(len(sketch), i))
            least[i] = max(1, len(sketch) - (len(self.sets[i]) - self.need[i]))
        flat, owner = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(flat, kind="stable")
        keys, first = np.unique(flat[order], return_index=True)
        self.filter[width][(keys & np.uint64(_FILTER_BITS - 1)).astype(np.int64)] = True
        return SizePartition(width, keys, np.append(first, len(flat)), owner[order], least)

    def search(self, text: str | None) -> list[tuple[int, int]]:
        """(item position, shared shingles) of every item the text holds enough of."""
        words = word_hashes(text)
        found = []
        for width in self.widths:
            if len(words) < width:
                continue
            own = shingle_hashes(words, width)
            near = own[self.filter[width][(own & np.uint64(_FILTER_BITS - 1)).astype(np.int64)]]
            if not len(near):
                continue
            near = np.unique(near)
            whole = None
            for part in self.parts:
                if part.width != width:
                    continue
                at = np.searchsorted(part.hashes, near)
                at = at[(at < len(part.hashes))]
                at = at[np.isin(part.hashes[at], near, assume_unique=False)] if len(at) else at
                if not len(at):
                    continue
                at = np.unique(at)
                hits = np.concatenate([part.items[part.first[k]:part.first[k + 1]] for k in at])
                item, count = np.unique(hits, return_counts=True)
                for i in item[count >= part.least[item]].tolist():
                    whole = np.unique(own) if whole is None else whole
                    pos = np.searchsorted(whole, self.sets[i])
                    pos[pos == len(whole)] = 0
                    shared = int((whole[pos] == self.sets[i]).sum())
                    if shared >= self.need[i]:
                        found.append((i, shared))
        return sorted(found)


def _blocks(texts: DataFrame):
    """The different item texts (key, text), a bounded block at a time."""
    total = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n = max(1, -(-total["n"] // BLOCK_ITEMS), -(-(total["b"] or 0) // BLOCK_BYTES))
    for k in range(n):
        part = texts if n == 1 else texts.where(F.pmod(F.xxhash64("key"), F.lit(n)) == k)
        table = part.orderBy("key").toArrow()
        if table.num_rows:
            yield table.column("key").to_pylist(), table.column("text").to_pylist(), k == n - 1


def _texts(items: DataFrame, item_id: str) -> tuple[DataFrame, DataFrame]:
    """(item_id, key of its text) per item row with a text, and the different texts by key, written."""
    held = items.select(F.col(item_id).alias("item_id"), "text", F.sha2("text", 256).alias("key")).where(F.length("text") > 0)
    return held.select("item_id", "key"), written(held.groupBy("key").agg(F.first("text").alias("text")), "benchmark-texts")


def contained_items(docs: DataFrame, items: DataFrame, item_id: str = "item_id", width: int = WIDTH,
                    share: tuple[int, int] = SHARE) -> DataFrame:
    """doc_id, item_id, item_shingles, shared, containment: every pair with at least the required share."""
    spark = docs.sparkSession
    fields = [("doc_id", pa.int64()), ("key", pa.string()), ("item_shingles", pa.int64()), ("shared", pa.int64()),
              ("containment", pa.float64())]
    rows, texts = _texts(items, item_id)
    results = []
    for keys, held, _ in _blocks(texts):
        index = spark.sparkContext.broadcast(ItemIndex(keys, held, width, share))  # bounded by the block

        def run(found, index=index):
            known = index.value
            for doc_id, text in found:
                for i, shared in known.search(text):
                    size = len(known.sets[i])
                    yield doc_id, known.ids[i], size, shared, shared / size

        results.append(written(map_rows(docs.select("doc_id", "text"), run, fields), "benchmark-found"))
        index.destroy()
    if not results:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, item_shingles bigint, shared bigint, "
                                         "containment double")
    return reduce(DataFrame.unionByName, results).join(rows, "key").select(
        "doc_id", "item_id", "item_shingles", "shared", "containment")


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, share: tuple[int, int] = SHARE) -> DataFrame:
    """The documents that hold no test item, with their columns; texts are judged where they lie, without a join.

    With several blocks what one block leaves is written before the next one is looked for.
    """
    spark = docs.sparkSession
    ship(spark)
    out, before = docs, None
    for keys, held, last in _blocks(_texts(items, "item_id")[1]):
        index = spark.sparkContext.broadcast(ItemIndex(keys, held, width, share))

        @F.pandas_udf("boolean")
        def leaks(column, index=index):
            return column.map(lambda t: bool(index.value.search(t)))

        out = out.where(~leaks(F.col("text")))
        if not last:
            out = written(out, "benchmark-clean")
            index.destroy()
            if before is not None:
                discard(before)
            before = out
    return out
