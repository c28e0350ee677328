"""Personal data in whole texts: plain detectors, and the same detectors after offset-preserving deobfuscation.

A transducer rewrites a text's disguises (look-alike letters, full-width and foreign digits, invisible
characters, spelled digits, ``at``/``dot`` in words or brackets) and keeps an edit list of (normalised range,
source range). Identifiers found in the normalised text are mapped back through that list to code points of
the source. Spans of the plain detectors always stay; a mapped span is added beside them unless it lies inside
one of its kind: one that only holds or overlaps a plain span is the whole identifier or its rest.

Cases: null and empty texts have no spans; detectors are linear in the text, however long; repeated rows and
null ids are kept row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import map_rows, ship

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOUBLED = str.maketrans({str(d): str(2 * d - 9 * (d > 4)) for d in range(10)})


def _emails(text: str) -> list[Span]:
    found, last = [], 0
    for m in _EMAIL_TAIL.finditer(text):
        at = start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            found.append(("email", start, m.end()))
            last = m.end()
    return found


def _ips(text: str) -> list[Span]:
    return [("ip", m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    doubled = digits[-2::-2].translate(_DOUBLED)
    return (sum(map(int, odd)) + sum(map(int, doubled))) % 10 == 0


def _cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    return found


def _phones(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def base_spans(text: str) -> list[Span]:
    """Spans of the plain detectors, by kind as listed and then start, in code points, end exclusive."""
    return _emails(text) + _ips(text) + _cards(text) + _phones(text)


# ---- deobfuscation -------------------------------------------------------------------------------------

# Letters that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-",
}
_INVISIBLE = "­​‌‍⁠﻿"
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
               "seven": "7", "eight": "8", "nine": "9"}
_ODD = re.compile("[^\u0000-\u00ac\u00ae-\u02ff]")
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_WORD = "|".join(DIGIT_WORDS)
# Endings that tell a spoken point ("example dot com") from prose where no "at" does.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "ai", "dev", "uk", "us", "de", "fr", "es", "it", "nl",
           "eu", "ch", "at", "be", "pl", "se", "ru", "in", "jp", "cn", "br", "ca", "au", "mx")
_LABEL = r"[a-z0-9-]{1,63}"
_POINT = rf"(?:\s{{1,3}}dot\s{{1,3}}|\s{{0,3}}{_OPEN}\s{{0,3}}(?:dot|\.)\s{{0,3}}{_CLOSE}\s{{0,3}})"
_TAIL = rf"(?:{_LABEL}{_POINT}){{0,3}}(?:{'|'.join(ENDINGS)})\b"
_BRACKET_AT = rf"\s{{0,3}}{_OPEN}\s{{0,3}}(?:at|@)\s{{0,3}}{_CLOSE}\s{{0,3}}"
# An address with a disguised dot may have any ending ("john at example dot dk"). Before a noun ("at the dot of
# noon") "dot" is no separator; there a listed ending is needed.
_ADDRESS = (rf"(?:@|{_BRACKET_AT}|(?<=[a-z0-9._%+-])\s{{1,3}}at\s{{1,3}})(?!(?:the|an?|this|that|each|every)\b)"
            rf"{_LABEL}(?:(?:{_POINT}|\.){_LABEL}){{0,8}}{_POINT}[a-z]{{2,63}}(?![a-z0-9-])")
_AT_DOT = re.compile(
    rf"(?P<address>{_ADDRESS})|(?P<at>{_BRACKET_AT})"
    rf"|(?P<dot>\s{{0,3}}{_OPEN}\s{{0,3}}(?:dot|\.)\s{{0,3}}{_CLOSE}\s{{0,3}})"
    rf"|(?P<spoken>(?<=[a-z0-9._%+-])\s{{1,3}}at\s{{1,3}}(?={_LABEL}{_POINT}{_TAIL}))"
    rf"|(?P<point>(?<=[a-z0-9])\s{{1,3}}dot\s{{1,3}}(?={_TAIL}))",
    re.IGNORECASE)
# Generic endings of three letters and more; any two letters may be a country's.
GENERIC_ENDINGS = frozenset((
    "com org net edu gov mil int info biz name pro museum aero coop jobs travel mobi cat tel asia post app dev shop "
    "online site store tech blog cloud email xyz club live news page wiki media agency academy center company digital "
    "group network solutions systems team tools work world").split())
_MAIL_VERB = re.compile(r"\b(?:e-?mails?|mailed|mailto|mails?|write|writes|wrote|contact|reach|send|sent|ping|message|address|cc|"
                        r"forward|reply)\b", re.IGNORECASE)
_LOCAL_SIGN = re.compile(r"[0-9._%+-][a-z0-9._%+-]*\Z", re.IGNORECASE)
_ADDRESS_AT = re.compile(rf"{_BRACKET_AT}|\s{{1,3}}at\s{{1,3}}|@", re.IGNORECASE)
_ADDRESS_DOT = re.compile(_POINT, re.IGNORECASE)
# Each match of _AT_DOT holds "dot", or a bracket with "at", "@" or "." behind it.
_BRACKETED = re.compile(rf"{_OPEN}\s{{0,3}}(?:at|@|\.)", re.IGNORECASE)
_DIGIT_WORD = re.compile(rf"\b(?:{_WORD})\b", re.IGNORECASE)
_GAP = re.compile(r"[\s.-]{0,3}")
_DIGIT_POINT, _POINT_DIGIT = re.compile(r"[0-9]\."), re.compile(r"\.[0-9]")
_SPOKEN_DOT = re.compile(r"\s{1,3}dot\s{1,3}", re.IGNORECASE)
#: Plus, before as many digits as a phone number has at least.
_PLUS = re.compile(rf"\bplus[\s-]{{0,3}}(?=(?:(?:{_WORD}|[0-9])[\s().-]{{0,3}}){{9}})", re.IGNORECASE)
#: From so many digit words on, a run is one number whatever stands between them.
_LONG_RUN = 7


def _plain(c: str) -> str:
    """What one unusual character stands for."""
    if c in _INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.digit(c, None)
    return c if digit is None else str(digit)


class Normalised:
    """A rewritten text and the edit list that leads back to its source."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        """edits: (source start, source end, replacement), in order and apart."""
        parts, self._at, self._from, self._edit = [], [0], [0], [False]
        done = size = 0
        for start, end, put in edits:
            parts += [source[done:start], put]
            size += start - done
            self._at += [size, size + len(put)]
            self._from += [start, end]
            self._edit += [True, False]
            size += len(put)
            done = end
        parts.append(source[done:])
        self.text = "".join(parts)

    def _locate(self, at: int) -> int:
        return bisect_right(self._at, at) - 1

    def start(self, at: int) -> int:
        k = self._locate(at)
        return self._from[k] if self._edit[k] else self._from[k] + at - self._at[k]

    def end(self, at: int) -> int:
        """Source end of the normalised character before ``at``."""
        k = self._locate(at - 1)
        return self._from[k + 1] if self._edit[k] else self._from[k] + at - self._at[k]


def _characters(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    edits = []
    for m in _ODD.finditer(text):
        put = _plain(m[0])
        if put != m[0]:
            edits.append((m.start(), m.end(), put))
    return edits


def _is_address(text: str, m: re.Match, at: re.Match) -> bool:
    """Whether "x at y dot word" is an address and not prose, where both separators are bare words.

    A known ending tells it, or a second sign: digits or points before "at", or a word about mail shortly before.
    """
    spelled = m[0].lower()
    ending = spelled.split()[-1]
    if not at[0].strip().isalpha() or not re.search(r"\sdot\s+" + re.escape(ending) + r"\Z", spelled) or re.search(r"[^a-z0-9\s-]", spelled):
        return True
    return (len(ending) == 2 or ending in GENERIC_ENDINGS or bool(_LOCAL_SIGN.search(text, max(0, m.start() - 64), m.start()))
            or bool(_MAIL_VERB.search(text, max(0, m.start() - 48), m.start())))


def _at_dot(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _AT_DOT.finditer(text):
        if not m["address"]:
            edits.append((m.start(), m.end(), "@" if m["at"] or m["spoken"] else "."))
            continue
        at = _ADDRESS_AT.match(text, m.start(), m.end())
        if not _is_address(text, m, at):
            continue
        if at[0] != "@":
            edits.append((at.start(), at.end(), "@"))
        edits += [(d.start(), d.end(), ".") for d in _ADDRESS_DOT.finditer(text, at.end(), m.end())]
    return edits


def _spelled(text: str, low: str, points: bool) -> list[tuple[int, int, str]]:
    """Edits of digit words and of what stands between them; ``points``: a '.' inside a long run stays."""
    words = [m.span() for m in _DIGIT_WORD.finditer(text) if m[0].lower() in DIGIT_WORDS] \
        if any(w in low for w in DIGIT_WORDS) else []
    starts, ends = {s for s, _ in words}, {e for _, e in words}
    edits = [(s, e, DIGIT_WORDS[text[s:e].lower()]) for s, e in words]
    dots = []
    if "dot" in low:
        for m in _SPOKEN_DOT.finditer(text):
            if (m.start() in ends or "0" <= text[m.start() - 1:m.start()] <= "9") and (
                    m.end() in starts or "0" <= text[m.end():m.end() + 1] <= "9"):
                dots.append((m.start(), m.end(), "."))
    if words and "plus" in low:
        edits += [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]
    edges = {x for s, e, _ in dots for x in (s, e)}
    run: list[tuple[int, int]] = []

    def close():
        gaps = [(a, b) for (_, a), (b, _) in zip(run, run[1:])]
        start, end = run[0][0], run[-1][1]
        dotted = (start in edges or end in edges or any(text[a:b] == "." for a, b in gaps)
                  or _DIGIT_POINT.match(text, max(0, start - 2), start) or _POINT_DIGIT.match(text, end))
        if len(run) < _LONG_RUN and not dotted:
            return
        for a, b in gaps:
            if text[a:b] != "." or len(run) >= _LONG_RUN and not points:
                edits.append((a, b, ""))

    for s, e in words:
        if run and not _GAP.fullmatch(text, run[-1][1], s):
            close()
            run = []
        run.append((s, e))
    if run:
        close()
    return edits + dots


def _disguises(text: str) -> list[list[tuple[int, int, str]]]:
    """Edit lists of the disguises, each in order and apart; a second one where points may part spelled digits."""
    low = text.lower()
    fixed = _at_dot(text) if "dot" in low or _BRACKETED.search(text) else []
    found = []
    for points in (False, True):
        edits, done = [], 0
        for start, end, put in sorted(fixed + _spelled(text, low, points)):
            if start >= done and end > start:
                edits.append((start, end, put))
                done = end
        if edits not in found:
            found.append(edits)
    return found


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans seen only after normalisation, in source code points; none that lies inside a base span of its kind."""
    first = _characters(text)
    one = Normalised(text, first) if first else None
    plain = one.text if one else text
    taken = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    starts = {k: [s for s, _ in taken[k]] for k in KINDS}
    added = []
    for second in _disguises(plain):
        two = Normalised(plain, second) if second else None
        if not (one or two):
            continue
        for kind, start, end in base_spans(two.text if two else plain):
            if two:
                start, end = two.start(start), two.end(end)
            if one:
                start, end = one.start(start), one.end(end)
            k = bisect_right(starts[kind], start)
            if not (k and taken[kind][k - 1][1] >= end):
                added.append((kind, start, end))
    return list(dict.fromkeys(added))


def _key(span: Span) -> tuple[int, int, int]:
    return KINDS.index(span[0]), span[1], span[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, count per kind and digest of the plain spans, all spans as text, number of added spans."""
    def run(rows):
        for doc_id, text in rows:
            base = base_spans(text or "")
            more = added_spans(text or "", base)
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            yield (doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(),
                   joined(sorted(base + more, key=_key)), len(more))

    fields = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
              ("spans", pa.string()), ("n_added", pa.int64())]
    return map_rows(docs.select("doc_id", "text"), run, fields)


def masked_text(text: str | None) -> str | None:
    """The text with every span replaced by its kind's mark; the union of overlapping spans has the first one's."""
    if not text:
        return text
    base = base_spans(text)
    spans = sorted(((s, e, k) for k, s, e in base + added_spans(text, base)), key=lambda x: (x[0], -x[1]))
    if not spans:
        return text
    parts, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def mask(docs: DataFrame, column: str = "text") -> DataFrame:
    """The same rows and columns with masked texts; ``n_chars`` follows where there is such a column."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def run(texts):
        return texts.map(masked_text, na_action="ignore")

    out = docs.withColumn(column, run(F.col(column)))
    return out.withColumn("n_chars", F.length(column).cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out
