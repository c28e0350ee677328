"""Secret scan by one combined deterministic automaton over UTF-8 bytes.

Every rule is a sequence of byte classes with repeat counts. A rule's positions become a nondeterministic
automaton, subset construction makes it deterministic, and all rules run side by side as one product whose
states are minimised by partition refinement; its transition array (one 256-wide row per state) is the only
thing a scan touches. One pass over the bytes finds where a rule's leftmost match can no longer grow, and a
reversed automaton of that rule, run back from there, gives where it began.

Searching is leftmost and greedy per rule and goes on behind each match. Because a match must be followed in
one pass, a rule whose match could pass through an accepting point, go on and then fail is refused.

Cases: null and empty texts have no spans; the scan is linear in the text plus the found spans; repeated rows
and null ids are kept row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tickwise.llm.common import map_rows

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_DIGIT = bytes(range(ord("0"), ord("9") + 1))
_WORD = _UPPER + _LOWER + _DIGIT


@dataclass(frozen=True)
class Part:
    """``least`` to ``most`` bytes of a class; ``most`` None: without end. ``value``: counts for the rule's minimum."""

    allowed: frozenset
    least: int = 1
    most: int | None = 1
    value: bool = False


def one(chars: bytes, least: int = 1, most: int | None = 1, value: bool = False) -> Part:
    return Part(frozenset(chars), least, most, value)


def literal(text: str, any_case: bool = False, value: bool = False) -> list[Part]:
    both = lambda c: {c.lower(), c.upper()} if any_case else {c}
    return [Part(frozenset(ord(x) for x in both(c)), value=value) for c in text]


@dataclass(frozen=True)
class Rule:
    """Alternatives of part sequences. ``minimum``: bytes of the value parts (all parts if none is marked)."""

    kind: str
    alternatives: tuple[tuple[Part, ...], ...]
    minimum: int = 0


def _assignment() -> tuple[tuple[Part, ...], ...]:
    quote, space = one(b"\"'", 0, 1), one(b" ", 0, None)
    tail = [quote, space, one(b":="), space, quote, one(_WORD + b"+/_.=-", 1, None, value=True)]
    names = [literal(w, any_case=True) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")]
    return tuple(tuple(n + tail) for n in names)


#: The plain kinds first, in the order spans are listed; further ones are the method's additions.
RULES = (
    Rule("assign", _assignment(), 6),
    Rule("access", ((*literal("AKIA"), one(_UPPER + _DIGIT, 1, None)),), 20),
    Rule("hex", ((one(_DIGIT + b"abcdef", 24, None),),)),
    Rule("github", tuple((*literal("gh"), one(b"pousr"), *literal("_"), one(_WORD, 1, None)) for _ in "x"), 40),
    Rule("slack", ((*literal("xox"), one(b"abprs"), *literal("-"), one(_WORD + b"-", 1, None)),), 24),
    Rule("google", ((*literal("AIza"), one(_WORD + b"_-", 1, None)),), 39),
    Rule("stripe", tuple((one(b"sr"), *literal("k_live_"), one(_WORD, 1, None)) for _ in "x"), 24),
    Rule("pem", tuple((*literal("-----BEGIN "), *literal(k), *literal("PRIVATE KEY-----"))
                      for k in ("", "RSA ", "EC ", "DSA ", "OPENSSH ", "ENCRYPTED "))),
)
BASE_KINDS = ("assign", "access", "hex")


class _Positions:
    """One rule's parts as a nondeterministic automaton without empty moves."""

    def __init__(self, rule: Rule, backwards: bool = False):
        self.allowed: list[frozenset] = []
        self.after: list[set[int]] = []
        self.first: set[int] = set()
        self.last: set[int] = set()
        for parts in rule.alternatives:
            self._add(parts[::-1] if backwards else parts)

    def _add(self, parts) -> None:
        open_ends: set[int] = set()  # positions whose successor is still to come
        at_start = True
        for part in parts:
            copies = max(part.least, 1) if part.most is None else part.most
            for k in range(copies):
                p = len(self.allowed)
                self.allowed.append(part.allowed)
                self.after.append(set())
                for q in open_ends:
                    self.after[q].add(p)
                if at_start:
                    self.first.add(p)
                if part.most is None and k == copies - 1:
                    self.after[p].add(p)
                if k >= part.least:
                    open_ends = open_ends | {p}
                else:
                    open_ends, at_start = {p}, False
        self.last |= open_ends

    def step(self, states, byte: int, starting: bool) -> frozenset:
        reach = set(self.first) if starting else set()
        for s in states:
            reach |= self.after[s]
        return frozenset(p for p in reach if byte in self.allowed[p])


class _Search:
    """One rule's leftmost search: ordered threads, oldest first; a finished match restarts behind its end."""

    START: tuple = ()

    def __init__(self, rule: Rule):
        self.nfa = _Positions(rule)

    def _threads(self, state: tuple, byte: int, starting: bool) -> tuple:
        seen: set[int] = set()
        out = []
        for group in (*state, *([None] if starting else [])):
            moved = self.nfa.step(group or (), byte, group is None) - seen
            if moved:
                seen |= moved
                out.append(moved)
                if moved & self.nfa.last:
                    break  # the leftmost match is certain: later starts don't count any more
        return tuple(out)

    def accepting(self, state: tuple) -> bool:
        return bool(state) and bool(state[-1] & self.nfa.last)

    def move(self, state: tuple, byte: int) -> tuple[tuple, bool]:
        """The next state, and whether a match ended before this byte."""
        if not self.accepting(state):
            return self._threads(state, byte, True), False
        grown = self._threads(state, byte, False)
        if not grown:
            return self._threads((), byte, True), True
        if not self.accepting(grown) or len(grown) < len(state):
            raise ValueError("a match of this rule can go on and then fail")
        return grown, False


class Automaton:
    """Transition arrays of all rules. ``table[state + byte]`` is the next state times 256, or, from
    ``events`` on, an index of the next state and the rules whose match ends before that byte."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        searches = [_Search(r) for r in rules]
        classes = self._byte_classes(searches)
        members = [classes.index(c) for c in range(max(classes) + 1)]
        start = tuple(_Search.START for _ in rules)
        index, order, moves = {start: 0}, [start], []
        memo: dict = {}
        for state in order:  # grows while it is walked
            row = []
            for byte in members:
                to, ended = [], []
                for r, (s, part) in enumerate(zip(searches, state)):
                    key = (r, part, byte)
                    if key not in memo:
                        memo[key] = s.move(part, byte)
                    nxt, end = memo[key]
                    to.append(nxt)
                    if end:
                        ended.append(r)
                to = tuple(to)
                if to not in index:
                    index[to] = len(order)
                    order.append(to)
                row.append((index[to], tuple(ended)))
            moves.append(row)
        finals = [tuple(r for r, (s, p) in enumerate(zip(searches, state)) if s.accepting(p)) for state in order]
        block = self._minimise(moves, finals)
        n = max(block) + 1
        self.states, self.built = n, len(order)
        self.events = n * 256
        self.event_list: list[tuple[int, tuple[int, ...]]] = []
        self.final: list[tuple[int, ...]] = [()] * n
        seen: dict = {}
        rows: list[list[int]] = [[]] * n
        for s, b in enumerate(block):
            if rows[b]:
                continue
            self.final[b] = finals[s]
            row = []
            for to, ended in moves[s]:
                value = block[to] * 256
                if ended:
                    value = seen.setdefault((value, ended), self.events + len(self.event_list))
                    if value == self.events + len(self.event_list):
                        self.event_list.append((block[to] * 256, ended))
                row.append(value)
            rows[b] = [row[c] for c in classes]
        self.start = block[0] * 256
        self.table: list[int] = [x for row in rows for x in row]
        self.back = [self._backwards(r) for r in rules]

    @staticmethod
    def _byte_classes(searches) -> list[int]:
        marks = [tuple(b in a for s in searches for a in s.nfa.allowed) for b in range(256)]
        number: dict = {}
        return [number.setdefault(m, len(number)) for m in marks]

    @staticmethod
    def _minimise(moves, finals) -> list[int]:
        """Partition refinement: states are one if no input tells them apart."""
        number: dict = {}
        block = [number.setdefault(f, len(number)) for f in finals]
        while True:
            number = {}
            finer = [number.setdefault((block[s], tuple((block[to], e) for to, e in row)), len(number))
                     for s, row in enumerate(moves)]
            if len(set(finer)) == len(set(block)):
                return finer
            block = finer

    @staticmethod
    def _backwards(rule: Rule) -> tuple[list[list[int]], list[bool]]:
        """Deterministic automaton of the reversed rule; state 0 is the start, -1 is dead."""
        nfa = _Positions(rule, backwards=True)
        index, order, rows = {None: 0}, [None], []
        for state in order:
            row = []
            for byte in range(256):
                to = nfa.step(state or (), byte, state is None)
                if not to:
                    row.append(-1)
                    continue
                if to not in index:
                    index[to] = len(order)
                    order.append(to)
                row.append(index[to])
            rows.append(row)
        return rows, [bool(s and s & nfa.last) for s in order]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(rule, byte offset where its match ends), from one pass over the bytes."""
        table, events, state, found = self.table, self.events, self.start, []
        for at, byte in enumerate(data):
            state = table[state + byte]
            if state >= events:
                state, rules = self.event_list[state - events]
                for r in rules:
                    found.append((r, at))
        found += [(r, len(data)) for r in self.final[state >> 8]]
        return found

    def begin(self, rule: int, data: bytes, end: int, least: int) -> int:
        """Leftmost start, not before ``least``, of the rule's match that ends at ``end``."""
        rows, accepting = self.back[rule]
        state, found, at = 0, end, end
        while at > least:
            at -= 1
            state = rows[state][data[at]]
            if state < 0:
                break
            if accepting[state]:
                found = at
        return found

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start and then kind as listed; matches below the minimum left out."""
        data = text.encode("utf-8", "surrogatepass")
        found, last = [], [0] * len(self.rules)
        for r, end in self.ends(data):
            rule = self.rules[r]
            start = self.begin(r, data, end, last[r])
            last[r] = end
            if self._value(rule, data[start:end]) >= rule.minimum:
                found.append((start, r, end))
        found.sort()
        if not text.isascii():
            found = _code_points(data, found)
        return [(self.rules[r].kind, s, e) for s, r, e in found]

    @staticmethod
    def _value(rule: Rule, match: bytes) -> int:
        """Length of what the rule's marked last part took; of the whole match if none is marked."""
        tail = rule.alternatives[0][-1]
        if not tail.value:
            return len(match)
        n = 0
        while n < len(match) and match[len(match) - 1 - n] in tail.allowed:
            n += 1
        mark = next((k for k in range(len(match) - n, len(match)) if match[k] in b":="), None) if n else None
        separated = any(c in b":=" for c in match[:len(match) - n])
        return n if separated or mark is None else len(match) - mark - 1


def _code_points(data: bytes, found):
    """Byte offsets as code points, counted once from left to right."""
    marks = sorted({x for s, _, e in found for x in (s, e)})
    at, points, count = 0, {}, 0
    for m in marks:
        count += len(data[at:m].decode("utf-8", "surrogatepass"))
        points[m], at = count, m
    return [(points[s], r, points[e]) for s, r, e in found]


_BUILT: dict = {}


def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """The rules' automaton, compiled once per driver."""
    if rules not in _BUILT:
        _BUILT[rules] = Automaton(rules)
    return _BUILT[rules]


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, count per base kind, digest of the base spans, all spans as text."""
    compiled = docs.sparkSession.sparkContext.broadcast(automaton(rules))  # one row of 256 longs per state

    def run(rows):
        scanner = compiled.value
        for doc_id, text in rows:
            spans = scanner.spans(text or "")
            base = [x for x in spans if x[0] in BASE_KINDS]
            yield (doc_id, *(sum(k == kind for k, _, _ in base) for kind in BASE_KINDS),
                   hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))

    fields = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()),
              ("spans", pa.string())]
    return map_rows(docs.select("doc_id", "text"), run, fields)
