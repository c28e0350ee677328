"""N-gram Jaccard join with token-combination prefixes, exact for the given threshold.

A document's tokens are its distinct word shingles (63-bit hashes). Documents with equal sets collapse into one
class, a vertex, first. Tokens are put in a global order by a sketch of their counts, rare ones first, and the frequent
ones form classes of their own by hash. If two sets are similar enough, a set can hold only a few tokens the other
lacks, so its prefix is extended until the other must share, inside it, either a rare token or a pair of frequent
tokens of one class: single rare tokens and pairs of frequent ones are the index keys. The sketch has a fixed size
and steers the cost only; any order gives the same links.

The members of a key's bucket meet in salted slices. No pair leaves such a task: what could link, by length, by the
tokens the prefixes leave to share and by a bound from the sets' token counts in 64 classes, is joined to trees there,
so a bucket gives at most a row per member and slice. For long sets 64 classes bound little, and a chance token that two
of them share would chain a whole corpus of long documents together: where a bucket of long sets gives few candidates,
these leave as pairs and are judged by token counts in as many classes as suit the sets' sizes. The components of
trees and pairs hold every link. Each set moves
once to its component (to each pair of slices of a large one), where all its pairs are verified by exact intersection,
as a product of the sets' membership matrix over the tokens that several of them hold. Only sums leave that task as
well: links per vertex, and trees of the links. Nothing is capped; links, components and sets never reach the driver.

Cases: null, empty and wordless texts have 0 shingles and a component of their own; repeated rows and rows
that share an id are one vertex; a null id gets no component; an empty table gives an empty result; very long texts are
read whole; other columns, whatever their names, are not read, and pass through ``one_of_each`` as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import _M, _R, discard, longs, map_rows, mix, shingle_set, written
from tickwise.llm.graph import components
from tickwise.operators.joins import check_size

#: Slots of the sketch that tells frequent tokens and orders them: a byte each, the size of what is sent to the tasks.
SKETCH_SLOTS = 1 << 24
HEAVY_LEAST = 6
#: Members, and tokens, of a bucket or component that one task pairs with a slice of it.
_SLICE = 256
_SLICE_TOKENS = 1 << 21
#: Size up to which the places of the sets are broadcast: rows, and bytes of their keys.
MOST_ENDS, MOST_END_BYTES = 400_000, 32 << 20
_COUNT_EVERY = 4_000_000
#: Bits of the fixed-size filters that thin rows out before a shuffle; what passes by chance drops out in the join.
_SLOTS = 1 << 24
#: Classes of the token counts that bound what two sets can share.
_CLASSES = 64
#: Tokens a class at most, on average, where finer counts are taken, and the most classes of these.
_DENSE, _MOST_CLASSES = 4, 1 << 14
#: Candidates a member up to which a bucket of long sets gives the pairs themselves; beyond, it gives trees.
_PAIRS_A_MEMBER = 4
#: Columns of the membership matrix made at a time.
_COLUMNS = 4096


def _set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sets_table(docs: DataFrame, width: int) -> DataFrame:
    """Rows of two kinds, written once: per document (doc_id, n, key of its set); per task, tokens met often.

    A task counts the tokens of its different sets and passes on those it met at least twice (lossy counting:
    what it leaves out is rare there). Counts only order the tokens.
    """
    def run(rows):
        held: list[np.ndarray] = []
        size, seen = 0, set()

        def counts():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= 2
            for t, c in zip(longs(token[often]), n[often].tolist()):
                yield 1, None, None, None, t, c

        for doc_id, text in rows:
            tokens = shingle_set(text, width)
            key = _set_key(tokens) if len(tokens) else None
            yield 0, doc_id, len(tokens), key, None, None
            if key is None or key in seen:
                continue
            if len(seen) > 500_000:
                seen.clear()
            seen.add(key)
            held.append(tokens)
            size += len(tokens)
            if size >= _COUNT_EVERY:
                yield from counts()
                held, size = [], 0
        if held:
            yield from counts()

    fields = [("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()),
              ("token", pa.int64()), ("c", pa.int64())]
    return written(map_rows(docs.select("doc_id", "text"), run, fields, 4096), "ngram-sets")


def _levels(table: DataFrame, slots: int) -> np.ndarray:
    """A level per slot: 0 where all tokens of the slot are rare, else the quantised log of the largest count.

    Of fixed size, whatever the corpus holds; a rare token in a frequent token's slot counts as frequent.
    """
    levels = np.zeros(-(-slots // 8) * 8, np.uint8)
    if not slots:
        return levels
    counted = table.where("kind = 1").groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= HEAVY_LEAST)
    level = F.least(F.lit(127), F.floor(F.log2("c") * 4)).cast("bigint")
    slot = F.pmod(F.xxhash64("token"), F.lit(slots))
    each = counted.groupBy(slot.alias("slot")).agg(F.max(level).alias("level"))
    words = each.groupBy(F.shiftright("slot", 3).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(level, cast(slot % 8 as int) * 8)")).alias("m")).toArrow()
    levels.view(np.int64)[words.column("w").to_numpy()] = words.column("m").to_numpy()
    return levels


_PRIME1, _PRIME2, _PRIME3, _PRIME4, _PRIME5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                               0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def _spark_hash(x: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of a long column, as signed longs: XXH64 of eight bytes with seed 42."""
    u, left = np.uint64, lambda v, k: (v << np.uint64(k)) | (v >> np.uint64(64 - k))
    h = np.full(len(x), (42 + _PRIME5 + 8) & _M, u)
    h ^= left(x.view(u) * u(_PRIME2), 31) * u(_PRIME1)
    h = left(h, 27) * u(_PRIME1) + u(_PRIME4)
    h = (h ^ (h >> u(33))) * u(_PRIME2)
    h = (h ^ (h >> u(29))) * u(_PRIME3)
    return (h ^ (h >> u(32))).view(np.int64)


def signatures(tokens: np.ndarray, heavy: np.ndarray, rank: np.ndarray, num: int, den: int):
    """(single rare tokens, keys of pairs of frequent tokens, whether the prefix holds all rare tokens) of a set.

    Pair keys are odd; a single token's key is twice the token.

    ``tokens``: the sorted set; two sets link if den * shared >= num * (size of their union).
    """
    n = len(tokens)
    at = np.searchsorted(heavy, tokens)
    at[at == len(heavy)] = 0
    frequent = heavy[at] == tokens if len(heavy) else np.zeros(n, bool)
    return prefix_keys(tokens, frequent, rank[at] if len(heavy) else at, num, den)


def prefix_keys(tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray, num: int, den: int):
    """As :func:`signatures`, with each token's own mark and rank (of the frequent ones; ties go by token)."""
    n = len(tokens)
    none = np.empty(0, np.uint64)
    if n * den < num * (n + 1):
        return none, none, False  # only an equal set could link
    spare = n - -(-num * n // den)  # tokens that a linked set can lack
    rare = tokens[~frequent]
    if len(rare) > spare:
        return rare[:spare + 1], none, False
    own = np.flatnonzero(frequent)
    own = own[np.argsort(rank[own], kind="stable")]
    ordered = tokens[own]
    need = spare + 1 - len(rare)
    pairs = []
    level = int(log2(n))
    # A linked smaller set may lie one size level below; pairs are formed under the smaller one's classes.
    for size in {level, int(log2(max(1, -(-num * n // den))))}:
        classes = max(1, round((den - num) * 2 ** size / (3 * den)))
        which = ((ordered >> np.uint64(17)) % np.uint64(classes)).astype(np.int64)
        later = np.ones(len(ordered), bool)
        later[np.unique(which, return_index=True)[1]] = False  # a class's first token pairs with none before it
        end = int(np.searchsorted(np.cumsum(later), need)) + 1
        which, part = which[:end], ordered[:end]
        order = np.argsort(which, kind="stable")
        for group in np.split(part[order], np.flatnonzero(np.diff(which[order])) + 1):
            if len(group) > 1:
                i, j = np.triu_indices(len(group), 1)
                low, high = np.minimum(group[i], group[j]), np.maximum(group[i], group[j])
                pairs.append(mix(mix(low + np.uint64(size + 1)) * np.uint64(3) + high) | np.uint64(1))
    return rare, np.unique(np.concatenate(pairs)) if pairs else none, True


def _class_counts(tokens: np.ndarray, classes: int = _CLASSES) -> np.ndarray:
    """Tokens of a set per class of tokens, 255 for more; ``classes`` is a power of two."""
    return np.minimum(np.bincount((mix(tokens) & np.uint64(classes - 1)).astype(np.int64), minlength=classes), 255).astype(np.uint8)


def _finer_counts(tokens: np.ndarray) -> bytes | None:
    """Token counts in so many classes that each has two to _DENSE tokens on average; None where _CLASSES do."""
    if len(tokens) <= _DENSE * _CLASSES:
        return None
    return _class_counts(tokens, min(_MOST_CLASSES, 1 << (-(-len(tokens) // _DENSE) - 1).bit_length())).tobytes()


def _could_link(x: bytes, y: bytes, n: int, num: int, den: int) -> bool:
    """Whether two sets of together ``n`` tokens can link, by their token counts; the finer ones are folded."""
    x, y = (np.frombuffer(c, np.uint8) for c in (x, y))
    if x.max() == 255 or y.max() == 255:  # counts of a full class are not known
        return True
    width = min(len(x), len(y))
    x, y = (c.reshape(-1, width).sum(axis=0, dtype=np.int64) for c in (x, y))
    return int(np.minimum(x, y).sum()) * (num + den) >= n * num


def _signature_table(docs: DataFrame, width: int, num: int, den: int, levels: np.ndarray, slots: int) -> DataFrame:
    """doc_id, key, n, full, singles, pairs, counts, finer of every document that could link with one of another set."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # of fixed size

    def run(rows):
        known = shared.value
        for doc_id, text in rows:
            tokens = shingle_set(text, width)
            level = known[np.mod(_spark_hash(tokens), slots)] if slots and len(tokens) else np.zeros(len(tokens), np.uint8)
            singles, pairs, full = prefix_keys(tokens, level > 0, level, num, den)
            if len(singles) or len(pairs):
                yield (doc_id, _set_key(tokens), len(tokens), full, longs(singles), longs(pairs),
                       _class_counts(tokens).tobytes(), _finer_counts(tokens))

    fields = [("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("full", pa.bool_()),
              ("singles", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())), ("counts", pa.binary()),
              ("finer", pa.binary())]
    return map_rows(docs.select("doc_id", "text"), run, fields)


def _slot(c: str | Column, *salt: Column) -> Column:
    return F.pmod(F.xxhash64(c, *salt), F.lit(_SLOTS))


def _marks(slots: DataFrame) -> DataFrame:
    """The column ``s`` of slots as words (w, m) of a bit map of _SLOTS bits: at most _SLOTS / 64 rows."""
    return slots.groupBy(F.shiftright("s", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("m"))


def _bit_map(slots: DataFrame) -> np.ndarray:
    """The column ``s`` of slots as a bit map of _SLOTS bits; its size does not depend on the rows."""
    marks = _marks(slots).toArrow()
    words = np.zeros(_SLOTS // 64, np.int64)
    words[marks.column("w").to_numpy()] = marks.column("m").to_numpy()
    return words


def _marked_sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(id, key, tokens) of the documents whose id occurs in ``ids``, and of a few that a shared slot lets through."""
    bits = docs.sparkSession.sparkContext.broadcast(_bit_map(ids.select(_slot("id").alias("s"))))

    def run(rows):
        marked = bits.value
        for doc_id, s, text in rows:
            if (int(marked[s >> 6]) >> (s & 63)) & 1:
                tokens = shingle_set(text, width)
                yield doc_id, _set_key(tokens), tokens.tobytes()

    return map_rows(docs.where(F.col("doc_id").isNotNull()).select("doc_id", _slot("doc_id").alias("s"), "text"),
                    run, [("id", pa.int64()), ("key", pa.binary()), ("tokens", pa.binary())], 128)


def _members(own: DataFrame, num: int, den: int) -> DataFrame:
    """Per document the keys it shares with another one: (id, n, s, counts, sigs); documents without any are left out.

    sigs: (sig, c), the key and how many documents have it, by key.
    ``s`` bounds what the document can share where it meets another in a pair key: tokens only it has cannot be
    shared, and a prefix with all rare tokens tells which those are.
    """
    keys = F.concat(F.transform("singles", lambda t: F.shiftleft(t, 1)), "pairs")
    met = written(own.select(F.explode(keys).alias("sig")).groupBy("sig").agg(F.count("*").alias("c"))
                  .where("c > 1").select("sig", F.col("c").cast("int").alias("c")), "ngram-met")
    shift = np.uint64(64 - _SLOTS.bit_length() + 1)
    spread = lambda c: (c * np.uint64(_R)) >> shift
    slots = map_rows(met.select("sig"), lambda rows: ((int(spread(np.array([sig], np.int64).view(np.uint64))[0]),)
                                                      for sig, in rows), [("s", pa.int64())], 8192)
    bits = own.sparkSession.sparkContext.broadcast(_bit_map(slots))

    def thin(rows):
        marked = bits.value
        for doc_id, n, full, n_singles, sigs in rows:
            own_keys = np.unique(np.array(sigs, np.int64))
            s = spread(own_keys.view(np.uint64)).astype(np.int64)
            kept = own_keys[(marked[s >> 6] >> (s & 63)) & 1 == 1]
            if len(kept):
                yield doc_id, n, full, n_singles, kept.tolist()

    fields = [("id", pa.int64()), ("n", pa.int64()), ("full", pa.bool_()), ("n_singles", pa.int64()),
              ("sigs", pa.list_(pa.int64()))]
    thinned = map_rows(own.select("doc_id", "n", "full", F.size("singles").cast("bigint").alias("n_singles"),
                                  keys.alias("sigs")), thin, fields)
    found = thinned.select(F.explode("sigs").alias("sig"), "id", "n", "full", "n_singles").join(met, "sig")
    # A document's keys come together again; they are as many as its prefix has.
    each = found.groupBy("id", "n", "full", "n_singles").agg(F.collect_set(F.struct("sig", "c")).alias("sigs"))
    shared = F.size(F.filter("sigs", lambda t: t["sig"].bitwiseAND(1) == 0))
    able = F.when(F.col("full"), F.col("n") - F.col("n_singles") + shared).otherwise(F.col("n"))
    linkable = F.when(F.col("s") * den >= F.col("n") * num, F.col("sigs")).otherwise(
        F.filter("sigs", lambda t: t["sig"].bitwiseAND(1) == 0))
    kept = each.withColumn("s", able).select("id", "n", "s", linkable.alias("sigs")).where(F.size("sigs") > 0)
    out = written(kept.join(own.select(F.col("doc_id").alias("id"), "counts"), "id"), "ngram-members")
    discard(met)
    return out


def _slices(members: Column, tokens: Column | None = None) -> Column:
    """How many slices a group of so many members and tokens is cut into."""
    parts = [members / _SLICE, F.lit(1.0)] + ([tokens / _SLICE_TOKENS] if tokens is not None else [])
    return F.ceil(F.greatest(*parts)).cast("int")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt to the pairs of slices (first, second) of their group, cut into ``slices``: a large group is
    paired slice by slice. Adds ``slice``, a row's own slice; a row comes once per slice of its group."""
    own = F.pmod(F.xxhash64("vertex"), F.col("slices")).cast("int")
    dealt = rows.withColumn("slice", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    return dealt.withColumn("first", F.least("slice", "other")).withColumn("second", F.greatest("slice", "other")).drop(
        "slices", "other")


def _grouped(rows: Iterator[tuple], width: int, most: int) -> Iterator[list[list[tuple]]]:
    """Whole groups of rows that agree in their first ``width`` fields, about ``most`` rows of them at a time."""
    held, group, key, size = [], [], None, 0
    for row in rows:
        if group and row[:width] != key:
            held.append(group)
            size += len(group)
            group = []
            if size >= most:
                yield held
                held, size = [], 0
        key = row[:width]
        group.append(row)
    if group:
        held.append(group)
    if held:
        yield held


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that each of n places is connected with by the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _candidates(members: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b, pair) whose components hold every link, made inside the buckets: trees of what could link, or,
    marked ``pair``, each two that could."""
    each = members.select(F.inline("sigs"), F.col("id").alias("vertex"), "n", "s", "counts")
    dealt = _dealt(each.withColumn("slices", _slices(F.col("c")))).select(
        "sig", "first", "second", "slice", "vertex", "n", "s", "counts")
    order = ["sig", "first", "second"]

    def run(rows):
        for groups in _grouped(rows, 3, 20_000):
            groups = [g for g in groups if len(g) > 1]
            if not groups:
                continue
            flat = [r for g in groups for r in g]
            size = np.array([len(g) for g in groups])
            gid = np.repeat(np.arange(len(groups)), size)
            part, n, s = (np.array([r[k] for r in flat], np.int64) for k in (3, 5, 6))
            crossed = np.repeat([g[0][1] != g[0][2] for g in groups], size)
            paired = np.repeat([g[0][0] & 1 == 1 for g in groups], size)
            counts = np.frombuffer(b"".join(bytes(r[7]) for r in flat), np.uint8).reshape(-1, _CLASSES)
            left, right = [], []
            for shift in range(1, int(size.max())):
                i = np.flatnonzero(gid[:-shift] == gid[shift:])
                j = i + shift
                ok = np.minimum(n[i], n[j]) * den >= np.maximum(n[i], n[j]) * num
                ok &= ~paired[i] | (np.minimum(s[i], s[j]) * (num + den) >= (n[i] + n[j]) * num)
                ok &= ~crossed[i] | (part[i] != part[j])
                i, j = i[ok], j[ok]
                both = np.minimum(counts[i], counts[j])
                most = both.sum(axis=1, dtype=np.int64)
                ok = (most * (num + den) >= (n[i] + n[j]) * num) | (both == 255).any(axis=1)
                left.append(i[ok])
                right.append(j[ok])
            a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
            few = np.bincount(gid[a], minlength=len(groups)) <= _PAIRS_A_MEMBER * size
            few &= np.maximum.reduceat(n, np.cumsum(size) - size) > _DENSE * _CLASSES
            alone = few[gid[a]]
            for i, j in zip(a[alone].tolist(), b[alone].tolist()):
                yield min(flat[i][4], flat[j][4]), max(flat[i][4], flat[j][4]), True
            root = _roots(a[~alone], b[~alone], len(flat))
            for k in np.flatnonzero(root != np.arange(len(flat))).tolist():
                yield flat[root[k]][4], flat[k][4], False

    ordered = dealt.repartition(*order).sortWithinPartitions(*order)
    fields = [("a", pa.int64()), ("b", pa.int64()), ("pair", pa.bool_())]
    return map_rows(ordered, run, fields, 4096).where("a <> b").distinct()


def _judged(found: DataFrame, own: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) of ``found``, without the pairs whose finer token counts show that they do not link."""
    def run(rows):
        return ((a, b) for a, b, n, x, y in rows if _could_link(x, y, n, num, den))

    def end(name: str) -> DataFrame:
        return own.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"),
                          F.coalesce("finer", "counts").alias(f"counts_{name}"))

    pairs = found.where("pair").join(end("a"), "a").join(end("b"), "b").select(
        "a", "b", F.expr("n_a + n_b").alias("n"), "counts_a", "counts_b")
    return found.where("not pair").select("a", "b").unionByName(
        map_rows(pairs, run, [("a", pa.int64()), ("b", pa.int64())], 4096)).distinct()


def _shared_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """The exact size of the intersection of every two sets, from the tokens that at least two of them hold."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(fresh) - 1
    several = np.bincount(column)[column] > 1
    owner, column = owner[several], column[several]
    out = np.zeros((len(sets), len(sets)), np.int64)
    if not len(column):
        return out
    column = np.cumsum(np.concatenate(([True], column[1:] != column[:-1]))) - 1
    edge = np.searchsorted(column, np.arange(0, column[-1] + 1 + _COLUMNS, _COLUMNS))
    for lo, hi, base in zip(edge, edge[1:], range(0, int(column[-1]) + 1, _COLUMNS)):
        held = np.zeros((len(sets), min(_COLUMNS, int(column[-1]) + 1 - base)), np.float32)
        held[owner[lo:hi], column[lo:hi] - base] = 1
        out += (held @ held.T).astype(np.int64)  # sums of at most _COLUMNS ones are exact
    return out


def _verified(docs: DataFrame, width: int, num: int, den: int, classes: DataFrame, trees: DataFrame,
              every: bool = False) -> DataFrame:
    """What the exact links inside the trees' components give, a few rows per vertex.

    classes: key, class_id, vertex, size, several, n. Rows (kind, a, b, links): 0, a tree of the links; 1, per vertex a
    the documents (by size) it links with in one pair of slices; 2, every link, or those between vertices marked
    ``several`` only.
    """
    placed = components(trees).select(F.col("id").alias("vertex"), "component").join(classes, "vertex")
    sizes = placed.groupBy("component").agg(_slices(F.count("*"), F.sum("n")).alias("slices")).where("slices > 1")
    ends = written(placed.join(sizes, "component", "left").select(
        F.col("class_id").alias("id"), "key", "component", "vertex", "size", "several",
        F.coalesce("slices", F.lit(1)).alias("slices")), "ngram-ends")
    # Where each set goes is told by a broadcast if its checked size allows it: the sets then move once.
    told = F.broadcast(ends) if check_size(ends, MOST_ENDS, MOST_END_BYTES).bounded else ends
    dealt = _dealt(_marked_sets(ends.select("id"), docs, width).join(told, ["id", "key"])).select(
        "component", "first", "second", "slice", "vertex", "size", "several", "tokens")
    order = ["component", "first", "second"]

    def run(rows):
        for (group,) in _grouped(rows, 3, 1):
            if len(group) < 2:
                continue
            crossed = group[0][1] != group[0][2]
            tokens = [np.frombuffer(r[7], np.uint64) for r in group]
            n = np.array([len(t) for t in tokens])
            linked = _shared_tokens(tokens) * (num + den) >= (n[:, None] + n[None, :]) * num
            np.fill_diagonal(linked, False)
            if crossed:
                part = np.array([r[3] for r in group])
                linked &= part[:, None] != part[None, :]
            a, b = np.nonzero(np.triu(linked))
            if not len(a):
                continue
            total = linked @ np.array([r[5] for r in group], np.int64)
            vertex, several = [r[4] for r in group], np.array([r[6] for r in group], bool)
            root = _roots(a, b, len(group))
            for k in np.flatnonzero(total > 0).tolist():
                yield 1, vertex[k], None, int(total[k])
                if root[k] != k:
                    yield 0, vertex[root[k]], vertex[k], None
            told = slice(None) if every else several[a] & several[b]
            for i, j in zip(a[told].tolist(), b[told].tolist()):
                yield 2, min(vertex[i], vertex[j]), max(vertex[i], vertex[j]), None

    ordered = dealt.repartition(*order).sortWithinPartitions(*order)
    fields = [("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())]
    out = written(map_rows(ordered, run, fields, 4096), "ngram-links")
    discard(ends)
    return out


def _prepared(docs: DataFrame, width: int, num: int, den: int, slots: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(each row with its key, classes, candidate trees) of the documents, all written."""
    table = _sets_table(docs, width)
    levels = _levels(table, slots)
    each = written(table.where("kind = 0").select("doc_id", "n", "key"), "ngram-each")
    discard(table)
    held = each.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull()).select("key", "doc_id", "n").distinct()
    texts = held.groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1").select("doc_id", F.lit(1).alias("more"))
    classes = held.join(texts, "doc_id", "left").groupBy("key").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("size"), F.max("more").isNotNull().alias("several"),
        F.max("n").alias("n"))
    # Texts under one id may be the smallest of several classes: such a class is named by a hash of its set.
    clash = classes.groupBy("class_id").agg(F.count("*").alias("c")).where("c > 1").select("class_id", F.lit(True).alias("clash"))
    classes = written(classes.join(clash, "class_id", "left").select(
        "key", "class_id", F.when(F.col("clash"), F.xxhash64("key")).otherwise(F.col("class_id")).alias("vertex"), "size",
        "several", "n"), "ngram-classes")
    own = written(_signature_table(docs, width, num, den, levels, slots).join(
        classes.select("key", F.col("class_id").alias("doc_id"), "vertex"), ["doc_id", "key"]).select(
        F.col("vertex").alias("doc_id"), "n", "full", "singles", "pairs", "counts", "finer"), "ngram-leaders")
    members = _members(own, num, den)
    found = written(_candidates(members, num, den), "ngram-candidates")
    discard(members)
    trees = written(_judged(found, own, num, den), "ngram-trees")
    discard(own, found)
    return each, classes, trees


def _membership(each: DataFrame, classes: DataFrame) -> DataFrame:
    return each.join(classes.select("key", "class_id", "vertex"), "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.col("vertex")).alias("vertex"))


def _several(rows: DataFrame) -> DataFrame:
    """(doc_id, a, b): the vertices a of documents with several different texts, and the least one b of each."""
    held = rows.where(F.col("vertex").isNotNull())
    return held.join(held.groupBy("doc_id").agg(F.countDistinct("vertex").alias("k"), F.min("vertex").alias("b"))
                     .where("k > 1"), "doc_id").select("doc_id", F.col("vertex").alias("a"), "b").distinct()


def _component_ids(found: DataFrame, classes: DataFrame, several: DataFrame) -> DataFrame:
    """vertex, component_id (the smallest doc_id reachable) of every vertex that links or has a document in common."""
    grouped = components(found.where("kind = 0").select("a", "b").unionByName(several.select("a", "b").where("a <> b")))
    placed = grouped.join(classes.select(F.col("vertex").alias("id"), "class_id"), "id")
    least = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    return placed.join(least, "component").select(F.col("id").alias("vertex"), "component_id")


def similarity_classes(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                       heavy_tokens: int = SKETCH_SLOTS) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id with an equal set), component_id per row of ``docs``.

    Two documents link when den * shared shingles >= num * shingles in either. ``heavy_tokens``: slots of the sketch
    of frequent tokens, 0 for none.
    """
    return similarity_join(docs, width, num, den, heavy_tokens).drop("n_links")


def similarity_links(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                     heavy_tokens: int = SKETCH_SLOTS) -> tuple[DataFrame, DataFrame]:
    """The whole join: (links, membership).

    links: (a, b), a < b, every two classes of equal sets that link, each once. membership: doc_id, n_shingles,
    class_id and vertex (the class as links name it) per row of ``docs``; a vertex is the class_id, or a hash of
    the set where texts under one id are the smallest of several classes. Null id or no shingle: vertex null.
    Near copies are paired with each other here; :func:`similarity_join` has their number without the pairs.
    """
    each, classes, trees = _prepared(docs, width, num, den, heavy_tokens)
    found = _verified(docs, width, num, den, classes, trees, every=True)
    return found.where("kind = 2").select("a", "b"), written(_membership(each, classes), "ngram-membership")


def similarity_join(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                    heavy_tokens: int = SKETCH_SLOTS) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, n_links per row of ``docs``.

    ``n_links``: texts of other documents that link with the row's, equal sets included; a document counts once per
    different set it has. Null for a null id.
    """
    each, classes, trees = _prepared(docs, width, num, den, heavy_tokens)
    found = _verified(docs, width, num, den, classes, trees)
    discard(trees)
    rows = _membership(each, classes)
    # Documents with several different texts: one vertex for the components, no link of their own.
    several = written(_several(rows), "ngram-several")
    links = found.where("kind = 2").select("a", "b").distinct()
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    itself = both.join(several.select("doc_id", "a"), "a").join(
        several.select("doc_id", F.col("a").alias("b")), ["doc_id", "b"]).groupBy("doc_id", "a").agg(
        F.count("*").alias("itself")).withColumnRenamed("a", "vertex")
    others = found.where("kind = 1").groupBy(F.col("a").alias("vertex")).agg(F.sum("links").alias("others"))
    known = classes.select("vertex", "size", "class_id").join(others, "vertex", "left").join(
        _component_ids(found, classes, several), "vertex", "left").select(
        "vertex", F.coalesce("component_id", "class_id").alias("component_id"),
        (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    return rows.join(known, "vertex", "left").join(itself, ["doc_id", "vertex"], "left").select(
        "doc_id", "n_shingles", "class_id", F.coalesce("component_id", "class_id").alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0)) - F.coalesce("itself", F.lit(0))).alias("n_links"))


def _met(rows: DataFrame, ids: DataFrame, how: str = "left_semi", salt: int = 0) -> DataFrame:
    """The rows whose doc_id shares a slot with one of ``ids``, or, by ``left_anti``, the others.

    The marks that tell it are of fixed size, so they are broadcast and no row of ``rows`` moves.
    """
    marks = F.broadcast(_marks(ids.select(_slot("doc_id", F.lit(salt)).alias("s"))))
    slot = _slot(rows["doc_id"], F.lit(salt))
    bit = F.call_function("shiftright", marks["m"], F.pmod(slot, F.lit(64)).cast("int")).bitwiseAND(1)
    return rows.join(marks, (F.shiftright(slot, 6) == marks["w"]) & (bit == 1), how)


def _within(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is one of ``ids``. Only they move, and what shares a slot with them."""
    return _met(docs, ids).join(ids, "doc_id", "left_semi").select(*docs.columns)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is none of ``ids``, those without one included; hardly a text moves.

    Rows in no slot of ``ids`` stay as they are. Of the others those to be kept are found by their ids alone, and
    mark slots by another hash: who is in none of these is one of ``ids``. The join decides the few in both.
    """
    spared = _met(docs.select("doc_id"), ids).join(ids, "doc_id", "left_anti")
    unsure = _met(_met(docs, ids), spared, salt=1)
    return _met(docs, ids, "left_anti").unionByName(unsure.join(ids, "doc_id", "left_anti").select(*docs.columns))


def one_of_each(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id; columns as they are.

    Rows with a null id are linked with nothing and stay; of rows that share an id one stays.
    """
    found = written(similarity_classes(docs, width, num, den).where(F.col("doc_id").isNotNull()), "ngram-groups")
    told = found.groupBy("doc_id").agg(F.min("component_id").alias("keeper"), F.count("*").alias("rows")).where(
        "doc_id <> keeper or rows > 1")
    told = written(told, "ngram-told")
    single = _without(docs, told.select("doc_id"))
    twice = told.where("doc_id = keeper").select("doc_id")
    if twice.isEmpty():
        return single
    return single.unionByName(_within(docs, twice).dropDuplicates(["doc_id"]))
