"""Conversation repair against a plain dynamic program that compares whole audits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from helpers import prose

from tickwise.llm import conversations as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
_NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(symbols):
    """(cost, least audit) of (initial, truncated, gone) symbols by comparing whole audits."""
    symbols = tuple(symbols)

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        found = []
        if i == len(symbols):
            if state in ("", "a"):
                found.append((0, ""))
        else:
            initial, truncated, gone = symbols[i]
            found.append((4, "D", i + 1, state))
            if not gone:
                if (state, initial) in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                    found.append((3 * truncated, "K", i + 1, initial))
                found.append((3 + 3 * truncated, "R", i + 1, _NEXT[state]))
        if inserts < 3:
            found.append((3, "I", i, _NEXT[state]))
        done = []
        for f in found:
            if len(f) == 2:
                done.append(f)
                continue
            rest = best(f[2], f[3], inserts + 1 if f[1] == "I" else 0)
            if rest is not None:
                done.append((f[0] + rest[0], f[1] + rest[1]))
        return min(done, default=None)

    return best(0, "", 0)


def reference(rows, harmed=True):
    """The contract's columns per conversation, row by row."""
    by_conv = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        kept = by_conv.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if harmed else 99
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, kept in by_conv.items():
        seen, symbols, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            visible = _VISIBLE.findall(text)
            fault = 0 if not visible else 1 if (role, text) in seen else 2 if visible[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            symbols.append((role[:1], fault == 2, fault in (0, 1)))
        initials = [r[:1] for _, r, _ in kept]
        cost, audit = cheapest(symbols)
        state, told, left = "", [], list(kept)
        for letter in audit:
            if letter != "I":
                _, role, text = left.pop(0)
            if letter == "D":
                continue
            state = role[0] if letter == "K" else _NEXT[state]
            told.append(f"{role}:{text}" if letter == "K" else
                        f"{'user' if state == 'u' else 'assistant'}:{'' if letter == 'I' else text}")
        turns = [t for t, _, _ in kept if t is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts,
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(told).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def rows_of(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def made(seed, conversations, most, numbers=50):
    r = random.Random(seed)
    texts = ["Fine.", "Fine.", "cut off", "Yes!", "", "  \n", "What?", "a. b", "tail. \t"]
    return [(c, t, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "sage", "", "Ada"]),
             r.choice(texts) if r.random() < 0.5 else f"text {r.randrange(numbers)}{r.choice(['.', '!', '', '? '])}")
            for c in range(conversations) for t in range(r.randrange(most + 1))]


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_blocks_give_the_cheapest_least_audit(block):
    tables = C.Tables(block)
    r = random.Random(block)
    for _ in range(1500):
        symbols = bytes(r.choice([0, 1, 2, 2, 3, 4, 4, 5, 6, 7, 8]) for _ in range(r.randrange(14)))
        plain = [("suao"[s >> 1] if s < 8 else "u", bool(s & 1) and s < 8, s == 8) for s in symbols]
        assert tables.repair(symbols) == cheapest(plain), symbols


def test_vectors_are_few_and_normalised():
    assert len(C.tables().vectors) < 200
    assert all(min(v) == 0 and max(v) <= 12 for v in C.tables().vectors)


def test_damaged_conversations(spark):
    rows = made(5, 400, 12)
    assert rows_of(C.report(C.damage(spark.createDataFrame(rows, SCHEMA)))) == reference(rows)


def test_undamaged_conversations(spark):
    rows = made(6, 150, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(C.report(C.as_they_are(df))) == reference(rows, harmed=False)


def test_repaired_texts_have_the_reported_digest(spark):
    rows = C.damage(spark.createDataFrame(made(7, 60, 10), SCHEMA))
    told = {}
    for r in C.repaired(rows).orderBy("conv_id", "turn").collect():
        told.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, found in rows_of(C.report(rows)).items():
        turns = told.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in turns))
        assert found[-1] == hashlib.sha256("\n".join(turns).encode()).hexdigest()


def test_long_conversation_over_many_segments(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT_ROWS", 64)
    rows = [(1, t, ["user", "assistant", "tool"][t * t % 3], f"text {t * 7 % 400}{'.' if t % 5 else ''}")
            for t in range(900)] + [(2, t, "user", "the same") for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(C.report(C.damage(df))) == reference(rows)


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "Hello."), (None, None, "assistant", "Hi."), (None, 3, None, None),
            (4, None, "user", "x"), (4, None, "user", "x"), (5, 7, "user", prose(4000, 1) + " " + "y" * 70_000 + "."),
            (5, 9, "assistant", "naïve 日本語."), (6, 1, None, "."), (7, 1, "", ""), (8, -5, "user", "ok."),
            (8, 12, "assistant", "\x00."), (9, 1, "system", "s."), (9, 1, "system", "s.")]
    for conv in range(10, 40):  # some of one row, that is dropped
        rows.append((conv, conv % 3, "user", "only."))
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("kind", "tie", "copy", "key", "pos", "segment", "audit", "id", "dropped"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    found = rows_of(C.report(C.damage(df)))
    assert found == reference(rows)
    assert any(f == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for f in found.values())


def test_rows_of_one_turn_have_a_fixed_order(spark):
    rows = [(1, 1, r, t) for r in ("user", "assistant") for t in ("b.", "a.", "c", "a.")]
    one = rows_of(C.report(C.damage(spark.createDataFrame(rows, SCHEMA).coalesce(1))))
    assert one == rows_of(C.report(C.damage(spark.createDataFrame(rows[::-1], SCHEMA).repartition(4))))


def test_empty_table(spark):
    df = C.report(C.damage(spark.createDataFrame([], SCHEMA)))
    assert df.collect() == [] and set(COLUMNS) <= set(df.columns)
