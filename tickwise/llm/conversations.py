"""Conversation structure repair by edit distance to a legal role sequence, with Four-Russians block tables.

A conversation is a string over nine symbols (role initial s, u, a or another, whole or truncated; or "must go").
Its cheapest edits into a sequence ``(s?(ua)+)?`` follow from costs-to-go over four automaton states: nothing yet,
behind s, behind u, behind a. Since a missing turn can be inserted in every state, the four costs differ by a bounded
amount, so a cost vector less its minimum is one of a few *normalised* vectors. For each of them and every block of
BLOCK symbols a table, made from the edit costs when first used, holds the normalised vector before the block and the
cost that the block adds. A conversation is solved from its end by one lookup a block. To trace the edits, a block is
then expanded: backward from the vector behind it, and forward from the state it is entered in, taking at each symbol
the least edit letter that stays on a cheapest way, which gives the least of all cheapest audits.

Rows are put in order by a range partitioning that cuts long conversations too, and repeated turns are found by the
first position of each text, so neither a long conversation nor a frequent turn lies in one task. What is gathered
per conversation is one byte per row, as its audit is. Only the digest of the repaired text, a chain by definition,
reads a conversation's texts one after the other; they are streamed, sorted, and never held together.

Order and cases: rows of a conversation go by turn, nulls first; rows of one turn by a hash of their role and text
(equal rows are interchangeable), and a repeated row follows its original. A null role or text is one space; a null
conv_id or turn is one space in the hashed key, and rows with a null conv_id are one conversation. A row without
visible text is blank, whatever its role; a role that is empty or begins otherwise than s, u or a fits nowhere as it
is. A conversation all of whose rows were dropped, or whose repair drops all, has the digest of the empty string.
Very long texts are hashed whole. An empty table gives an empty result. Other columns, whatever their names, are not
read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import map_rows, written

# The costs of the edits and the damage of the contract.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
DAMAGE_OF = 20
DROPPED, EMPTIED, UNSTOPPED, REPEATED, AS_USER = range(5)

BLOCK = 4
#: Symbols: 2 * class + truncated for the classes s, u, a, other; the last one must be deleted.
GONE = 8
SYMBOLS = GONE + 1
#: Automaton states: nothing yet, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or re-assigned turn leads, and the states that a kept class may follow and lead to.
_TURN = (USER, USER, ASSISTANT, USER)
_KEEP = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
_WHITE = " \t\n\x0b\x0c\r"
#: Rows of one segment of a conversation; a position is partition, segment and place in it.
SEGMENT_ROWS = 1 << 16
#: Expanded blocks remembered by a task.
_EXPANDED = 200_000


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    costs = list(costs)
    for _ in range(2):  # behind two insertions every state has been reached
        costs = [min(c, INSERT + costs[_TURN[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the ways to take a symbol, by letter."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        extra = TRUNCATED * (symbol & 1)
        if state in _KEEP[symbol >> 1]:
            found.append(("K", extra, _KEEP[symbol >> 1][state]))
        found.append(("R", REROLE + extra, _TURN[state]))
    return found


def _before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs-to-go in front of a symbol from those behind it."""
    return _with_inserts([min(c + costs[to] for _, c, to in _options(symbol, q)) for q in range(4)])


class Tables:
    """Normalised vectors (the first is that of the end), and their transitions by symbol and by block."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = _with_inserts([0, 1 << 30, 1 << 30, 0])
        self.vectors, self.step = [end], []
        number = {end: 0}
        for vector in self.vectors:  # grows while it is read: a search from the end's vector
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(vector, symbol)
                least = min(costs)
                normal = tuple(c - least for c in costs)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((number[normal], least))
            self.step.append(row)
        # blocks[vector behind][block number] = (vector in front, cost added); the first symbol counts most.
        to = np.array([[s[0] for s in row] for row in self.step])
        cost = np.array([[s[1] for s in row] for row in self.step])
        front, added = np.arange(len(self.vectors))[:, None], np.zeros((len(self.vectors), 1), np.int64)
        for _ in range(block):  # one more symbol in front of the blocks there are
            added = (added[:, None, :] + cost[front].transpose(0, 2, 1)).reshape(len(front), -1)
            front = to[front].transpose(0, 2, 1).reshape(len(front), -1)
        self.blocks = list(zip(front.tolist(), added.tolist()))
        self.expanded: dict[tuple, tuple[str, int]] = {}

    def _letters(self, behind: int, symbol: int, state: int) -> tuple[str, int]:
        """The least letters of a cheapest way over one symbol, insertions in front of it included; the next state."""
        front, added = self.step[behind][symbol]
        letters, after = "", self.vectors[behind]
        while True:
            left = self.vectors[front][state]
            options = _options(symbol, state)
            options.insert(1, ("I", INSERT, -1))
            for letter, cost, to in options:
                if letter == "I":
                    if cost + self.vectors[front][_TURN[state]] == left:
                        letters, state = letters + "I", _TURN[state]
                        break
                elif cost + after[to] == left + added:
                    return letters + letter, to

    def expand(self, behind: int, symbols: bytes, state: int) -> tuple[str, int]:
        """Letters over a run of symbols entered in ``state`` with ``behind`` the vector behind it; the next state."""
        key = (behind, symbols, state)
        found = self.expanded.get(key)
        if found is None:
            vectors = [behind]
            for symbol in reversed(symbols):
                vectors.append(self.step[vectors[-1]][symbol][0])
            letters = []
            for i, symbol in enumerate(symbols):
                piece, state = self._letters(vectors[len(symbols) - i - 1], symbol, state)
                letters.append(piece)
            found = "".join(letters), state
            if len(self.expanded) >= _EXPANDED:
                self.expanded.clear()
            self.expanded[key] = found
        return found

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """(least cost, least of the cheapest audits)."""
        n, size = len(symbols), self.block
        whole = n - n % size
        at, cost = 0, 0
        for symbol in reversed(symbols[whole:]):
            at, added = self.step[at][symbol]
            cost += added
        digits = np.frombuffer(symbols[:whole], np.uint8).reshape(-1, size).astype(np.int64)
        numbers = (digits @ (SYMBOLS ** np.arange(size - 1, -1, -1))).tolist() if whole else []
        behind = [at]
        for number in reversed(numbers):
            to, added = self.blocks[at]
            at, cost = to[number], cost + added[number]
            behind.append(at)
        cost += self.vectors[at][START]
        state, audit = START, []
        for k in range(len(numbers)):
            letters, state = self.expand(behind[len(numbers) - k - 1], symbols[k * size:(k + 1) * size], state)
            audit.append(letters)
        if whole < n:
            letters, state = self.expand(0, symbols[whole:], state)
            audit.append(letters)
        audit.append({START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state])
        return cost, "".join(audit)


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, tie, copy, dropped: the damaged rows. Dropped ones stay, marked."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % DAMAGE_OF
    each = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind") == EMPTIED, "").when(F.col("kind") == UNSTOPPED, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("kind") == AS_USER, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return each.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.xxhash64("role", "text").alias("tie"), F.explode(copies).alias("copy"),
                       (F.col("kind") == DROPPED).alias("dropped"))


def as_they_are(rows: DataFrame) -> DataFrame:
    """The rows in the form of :func:`damage`, undamaged."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                       F.xxhash64(spaced("role"), spaced("text")).alias("tie"), F.lit(0).alias("copy"),
                       F.lit(False).alias("dropped"))


_ORDER = ("turn", "tie", "copy")
_BLANK, _DUPLICATE, _CUT = 8, 16, 4


def _row_code() -> Column:
    """Class of the role's initial (0 to 3), 4 if truncated, 8 if blank; null for a dropped row."""
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    end = F.substring(F.rtrim(F.col("text"), F.lit(_WHITE)), -1, 1)
    return F.when(~F.col("dropped"), kind + F.when(end == "", _BLANK).when(end.isin(".", "!", "?"), 0).otherwise(_CUT))


def _placed(rows: DataFrame) -> DataFrame:
    """Two kinds of rows, written: 0, a visible turn's position and key; 1, a segment of a conversation.

    A segment has the codes of up to SEGMENT_ROWS rows in order, a byte each, and what gaps need of its turns.
    """
    key = F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.octet_length("role"),
                             F.col("role"), F.col("text")), 256)
    # The key tells texts apart by 128 bits; the salt spreads rows that are equal in all else.
    narrow = written(rows.select("conv_id", "turn", "tie", "copy", _row_code().cast("int").alias("code"),
                                 F.substring(F.unhex(key), 1, 16).alias("key"),
                                 F.xxhash64(F.monotonically_increasing_id()).alias("salt")), "conversation-rows")
    order = ["conv_id", *_ORDER, "salt"]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "code", "key")

    def run(rows):
        from pyspark import TaskContext

        part, segment = TaskContext.get().partitionId() << 40, -1
        none, codes, turns, now = object(), bytearray(), [], None
        now = none

        def closed():
            seen = [t for t in turns if t is not None]
            return (1, part + (segment << 16), now, None, bytes(codes), seen[0] if seen else None,
                    seen[-1] if seen else None, len(set(seen)))

        for conv_id, turn, code, key in rows:
            if now is none or conv_id != now or len(codes) >= SEGMENT_ROWS:
                if now is not none:
                    yield closed()
                segment, codes, turns, now = segment + 1, bytearray(), [], conv_id
            if code is None:
                continue
            if code < _BLANK:
                yield 0, part + (segment << 16) + len(codes), None, key, None, None, None, None
            codes.append(code)
            if not turns or turn != turns[-1]:
                turns.append(turn)
        if now is not none:
            yield closed()

    fields = [("kind", pa.int32()), ("pos", pa.int64()), ("conv_id", pa.int64()), ("key", pa.binary()),
              ("codes", pa.binary()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64())]
    return written(map_rows(ranged, run, fields, 4096), "conversation-order")


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of rows in the form of :func:`damage`."""
    placed = _placed(rows)
    first = placed.where("kind = 0").groupBy("key").agg(F.min("pos").alias("pos"))
    # The first turns of a segment, as places in it: at most SEGMENT_ROWS.
    firsts = first.groupBy(F.expr("pos >> 16").alias("segment")).agg(
        F.collect_list((F.col("pos") % SEGMENT_ROWS).cast("int")).alias("firsts"))
    segments = placed.where("kind = 1").select("conv_id", F.expr("pos >> 16").alias("segment"), "codes", "first_turn",
                                               "last_turn", "turns")

    def marked(found):
        for conv_id, segment, codes, firsts, first_turn, last_turn, turns in found:
            codes = np.frombuffer(codes, np.uint8).copy()
            again = codes < _BLANK
            again[np.array(firsts or [], np.int64)] = False
            codes[again] += _DUPLICATE
            yield conv_id, segment, codes.tobytes(), first_turn, last_turn, turns

    fields = [("conv_id", pa.int64()), ("segment", pa.int64()), ("codes", pa.binary()), ("first_turn", pa.int64()),
              ("last_turn", pa.int64()), ("turns", pa.int64())]
    each = map_rows(segments.join(firsts, "segment", "left").select(
        "conv_id", "segment", "codes", "firsts", "first_turn", "last_turn", "turns"), marked, fields)
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "segment", "codes", "first_turn", "last_turn", "turns"))).alias("segments"))

    def solved(found):
        lookup = tables()
        legal = np.zeros((4, 4), bool)
        legal[0, 1] = legal[1, 2] = legal[2, 1] = True
        symbol = np.full(32, GONE, np.uint8)
        symbol[:_BLANK] = [2 * (c & 3) + (c >= _CUT) for c in range(_BLANK)]
        for conv_id, segments in found:
            codes = np.frombuffer(b"".join(s["codes"] for s in segments), np.uint8)
            low = high = last = None
            turns = 0
            for s in segments:  # a turn may reach from one segment into the next
                if s["turns"]:
                    turns += s["turns"] - (last is not None and s["first_turn"] == last)
                    low, high, last = s["first_turn"] if low is None else low, s["last_turn"], s["last_turn"]
            role = codes & 3
            cost, audit = lookup.repair(symbol[codes].tobytes())
            yield (conv_id, high - low + 1 - turns if turns else 0, int(((codes & _BLANK) > 0).sum()),
                   int(((codes & _DUPLICATE) > 0).sum()),
                   int(((codes & _CUT > 0) & (codes < _BLANK)).sum()),
                   int((~legal[role[:-1], role[1:]]).sum()), cost, audit)

    fields = [("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal",
                                                                 "cost")), ("audit", pa.string())]
    return written(map_rows(whole, solved, fields), "conversation-audits")


def edited(audit: str, rows):
    """The repaired turns (role, text as bytes) of a conversation; ``rows``: its rows in order."""
    state = START
    rows = iter(rows)
    for letter in audit:
        if letter == "D":
            next(rows)
            continue
        role, text = next(rows) if letter != "I" else ("", b"")
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        else:
            state = _TURN[state]
            role = "user" if state == USER else "assistant"
        yield role, text


def _texts_by_audit(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit row followed by its rows in order, in sorted partitions."""
    empty = F.lit(None)
    kept = rows.where(~F.col("dropped")).select(
        "conv_id", F.lit(1).alias("kind"), *_ORDER, "role", F.col("text").cast("binary").alias("text"),
        empty.cast("string").alias("audit"))
    heads = found.select("conv_id", F.lit(0).alias("kind"), empty.cast("bigint").alias("turn"),
                         empty.cast("bigint").alias("tie"), empty.cast("int").alias("copy"), empty.cast("string").alias("role"),
                         empty.cast("binary").alias("text"), "audit")
    return heads.unionByName(kept).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER).select(
        "conv_id", "kind", "role", "text", "audit")


def _by_conversation(rows):
    """(conv_id, audit, its rows) one after the other; rows that were not asked for are passed over."""
    rows = iter(rows)
    head = next(rows, None)
    while head is not None:
        conv_id, following = head[0], [None]

        def own():
            for row in rows:
                if row[1] == 0:
                    following[0] = row
                    return
                yield row[2], row[3]

        turns = own()
        yield conv_id, head[4], turns
        for _ in turns:
            pass
        head = following[0]


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the repaired conversations; turns are counted from 0."""
    def run(found):
        for conv_id, audit, turns in _by_conversation(found):
            for n, (role, text) in enumerate(edited(audit, turns)):
                yield conv_id, n, role, text

    fields = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.binary())]
    return map_rows(_texts_by_audit(rows, audits(rows)), run, fields).withColumn("text", F.col("text").cast("string"))


def report(rows: DataFrame) -> DataFrame:
    """One row per conversation: what :func:`audits` gives and repaired_sha256, the digest of the repaired turns."""
    found = audits(rows)

    def run(each):
        for conv_id, audit, turns in _by_conversation(each):
            digest, first = hashlib.sha256(), True
            for role, text in edited(audit, turns):
                digest.update((role if first else "\n" + role).encode() + b":")
                digest.update(text)
                first = False
            yield conv_id, digest.hexdigest()

    digests = map_rows(_texts_by_audit(rows, found), run, [("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    named = digests.select(F.col("conv_id").alias("id"), "repaired_sha256")
    return found.join(named, found["conv_id"].eqNullSafe(named["id"])).drop("id")
