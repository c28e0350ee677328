import hashlib
import random
import re

import pytest

from helpers import AWKWARD, docs
from tickwise.llm import pii as op

PLAIN = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
         ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
         ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
         ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    found = []
    for kind, pattern in PLAIN:
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def test_plain_spans_match_the_patterns():
    r = random.Random(6)
    atoms = ["a", "@", ".", "b-c", "%", "1", "22", "255", "256", " ", "-", "+", "(555)", "4532015112830366", "x@y.z",
             "4111 1111 1111 1111", "é", "@@", "..", "0001", "\n", "555-1234", "٣"]
    for _ in range(20_000):
        text = "".join(r.choice(atoms) for _ in range(r.randrange(1, 14)))
        assert op.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text,kind,found", [
    ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
    ("write to john(at)example(dot)co(dot)uk!", "email", "john(at)example(dot)co(dot)uk"),
    ("john at example dot com", "email", "john at example dot com"),
    ("call plus one five five five one two three four five six seven ok", "phone",
     "plus one five five five one two three four five six seven"),
    ("\uff4a\uff4f\uff48\uff4e\uff20\uff45\uff58.com", "email", "\uff4a\uff4f\uff48\uff4e\uff20\uff45\uff58.com"),
    ("ну: jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("192[.]168[.]1[.]10", "ip", "192[.]168[.]1[.]10"),
    ("\u0664111 1111 1111 111\u0661", "card", "\u0664111 1111 1111 111\u0661"),
])
def test_disguised_spans_map_back(text, kind, found):
    base = op.base_spans(text)
    added = op.added_spans(text, base)
    assert (kind, found) in [(k, text[s:e]) for k, s, e in added]
    assert all(text[s:e] not in op.masked_text(text) for _, s, e in added)


@pytest.mark.parametrize("text", ["we met at the dot of noon", "one two three", "polka dot dress at home", "[at] last",
                                  "a normal sentence, with é and ü", "j@k.com is plain"])
def test_clean_texts_gain_nothing(text):
    assert op.added_spans(text, op.base_spans(text)) == []


@pytest.mark.parametrize("kind,found,plain", [
    ("email", "j\u043ehn@example.com", "hn@example.com"), ("email", "john@example.c\u043em", "john@example.c"),
    ("email", "jo\u200bhn@example.com", "hn@example.com"), ("email", "john[dot]smith@example.com", "smith@example.com"),
    ("email", "john@mail.example[dot]com", "john@mail.example"), ("phone", "+1 555 123 45\u0666\u0667", "+1 555 123 45"),
    ("ip", "10.0.0.2\u0665\u0665", "10.0.0.2"), ("ip", "1\u200b92.168.1.10", "92.168.1.10"),
])
def test_partly_disguised_spans_are_whole(kind, found, plain):
    text = f"see {found} now"
    base = op.base_spans(text)
    assert (kind, plain) in [(k, text[s:e]) for k, s, e in base]
    assert [(k, text[s:e]) for k, s, e in op.added_spans(text, base)] == [(kind, found)]
    assert op.masked_text(text) == f"see [{kind.upper()}] now"


@pytest.mark.parametrize("kind,found", [
    ("email", "john { at } example.com"), ("email", "john < at > example.com"), ("email", "x [at ] host.com"),
    ("email", "x@example[ . ]com"), ("email", "x@example<.>com"),
    *(("email", f"john at example dot {e}") for e in ("biz", "dk", "kr", "tr", "no", "me", "nz", "za", "museum")),
    ("email", "john at mail dot example dot dk"), ("email", "john at example [dot] com"),
    ("email", "john [at] example dot dk"), ("email", "JOHN AT EXAMPLE DOT DK"), ("email", "john@example dot dk"),
    ("ip", "192 dot 168 dot 1 dot 10"), ("ip", "one nine two.one six eight.one.one zero"), ("ip", "one.two.three.four"),
    ("ip", "one nine two dot one six eight dot one dot one zero"), ("ip", "192.168.one.one zero"),
    ("phone", "+1 555 one two three 4567"), ("phone", "plus 1 555 one two three 4567"),
    ("card", "4111 1111 one one one one 1111"), ("card", "four one one one one one one one 1111 1111"),
    ("card", "four.one.one.one.one.one.one.one.one.one.one.one.one.one.one.one"),
])
def test_no_disguise_needs_another_one(kind, found):
    text = f"{found}; now"
    assert (kind, found) in [(k, text[s:e]) for k, s, e in op.added_spans(text, op.base_spans(text))]
    assert op.masked_text(text).endswith("]; now")


def test_spelled_digits_do_not_widen_addresses():
    for text in ("I sent one two@example.com", "plus one two@example.com", "call one john@example.com",
                 "one \u017fix \u017feven"):
        assert op.added_spans(text, op.base_spans(text)) == []


def test_normalised_offsets_point_at_their_source():
    r = random.Random(8)
    for _ in range(2000):
        text = "".join(r.choice("abcdef") for _ in range(30))
        edits, at = [], 0
        while at < 26:
            at += r.randrange(1, 5)
            end = at + r.randrange(0, 4)
            if end <= 30:
                edits.append((at, end, r.choice(["", "X", "YZ"])))
            at = end + 1
        n = op.Normalised(text, edits)
        inside = {i for s, e, _ in edits for i in range(s, e)}
        for i, c in enumerate(n.text):
            if c not in "XYZ":
                assert text[n.start(i)] == c and n.start(i) not in inside and n.end(i + 1) == n.start(i) + 1


def test_linear_on_hostile_texts():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "one " * 80_000,
                 "( " * 150_000, "+1" + " " * 300_000):
        op.added_spans(text, op.base_spans(text))


def test_table(spark):
    rows = AWKWARD + [(50, "x a.b@c.de, +1 (555) 010-9999 and 10.0.0.255"), (50, "j at k dot org 4111111111111111")]
    got = op.find(docs(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    for x, (d, text) in zip(sorted(got, key=lambda x: (str(x.doc_id), x.spans)),
                            sorted(rows, key=lambda x: (str(x[0]), op.joined(sorted(
                                op.base_spans(x[1] or "") + op.added_spans(x[1] or "", op.base_spans(x[1] or "")),
                                key=op._key))))):
        base = brute(text or "")
        assert x.doc_id == d and [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(k == n for k, _, _ in base) for n in op.KINDS]
        assert x.base_sha256 == hashlib.sha256(op.joined(base).encode()).hexdigest()
        assert all(op.joined([s]) in x.spans for s in base)
    masked = op.mask(docs(spark, rows, extra=True)).collect()
    assert sorted(x.n_chars for x in masked if x.text) == sorted(len(x.text) for x in masked if x.text)
    assert any(x.text == "x [EMAIL], [PHONE] and [IP]" for x in masked) and any(x.text == "[EMAIL] [CARD]" for x in masked)
    assert op.find(docs(spark, [])).collect() == [] and op.mask(docs(spark, [])).collect() == []


PROSE_SUBJECTS = ["sat", "lives", "look", "arrived", "waited", "she stood", "they met", "we stopped", "he stayed", "it ended"]
PROSE_PLACES = ["home", "elm", "table", "station", "example", "school", "work", "noon", "length", "once"]
PROSE_TAILS = ["period", "street", "format", "after", "hence", "matrix", "product"]


def test_prose_with_at_and_dot_stays():
    for subject in PROSE_SUBJECTS:
        for place in PROSE_PLACES:
            for tail in PROSE_TAILS:
                for text in (f"{subject} at {place} dot {tail}", f"And {subject} at {place} dot {tail}, then left."):
                    assert op.added_spans(text, op.base_spans(text)) == [], text


@pytest.mark.parametrize("text", ["email john at corp dot intranet", "john.smith at corp dot intranet", "j7 at corp dot intranet",
                                  "john (at) corp dot intranet", "john at corp (dot) intranet", "john at example dot com"])
def test_second_sign_makes_an_address(text):
    assert [k for k, _, _ in op.added_spans(text, op.base_spans(text))] == ["email"]
