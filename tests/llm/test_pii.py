from __future__ import annotations

import random
import re
import time

import pytest
from llm.helpers import EDGE_TEXTS, by_id, frame, with_clashes

from tillhouse.llm import pii

SCHEMA = "doc_id long, text string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((number, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    pieces = ["a", "b@c.d", "@", ".", "-", " ", "+1 ", "4111 1111 1111 1111", "255", "256", "10.0.0.1", "(", ")", "12", "0", "é", "_%", "\n", "+44 20 7946 0958", "5555555555554444", "00", "x@y"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("piece", ["a", "7", "1.", "1 ", "+1 ", "a@", "@", "9@a.", "+", "(1)", "x7", "1234 ", "=1234:"])
def test_long_texts_take_linear_time(piece):
    n = 400_000 // len(piece)
    start = time.perf_counter()
    pii.base_spans(piece * n)
    assert time.perf_counter() - start < 4


def spans(docs):
    return {k: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for k, r in by_id(pii.private_spans(docs)).items()}


def texts_with_contexts():
    rows = [(i, f"word{i} please call me under +1 (555) 010-{1000 + i} some time") for i in range(6)]
    rows += [(10, "é please call me under 0171 555 2233 some time"), (11, "they said 0171 555 2233 again")]
    rows += [(20 + i, f"built in the year {1900 + i} by") for i in range(5)]
    rows += [(30 + i, f"his address is name{i}@example.com or") for i in range(4)]
    rows += [(40, "his address is mail=bob@localhost or"), (41, "an odd one was a@b here")]
    return rows


def test_contexts_find_what_patterns_miss(spark):
    got = spans(with_clashes(frame(spark, texts_with_contexts(), SCHEMA)))
    assert got[10] == [("like_phone", 23, 36)] and got[11] == [("like_phone", 10, 23)]
    assert got[40] == [("like_email", 20, 33)]
    assert all(not got[k] for k in (*range(20, 25), 41))
    assert all([s[0] for s in got[k]] == ["phone"] for k in range(6)) and all([s[0] for s in got[k]] == ["email"] for k in range(30, 34))


def test_discovery_goes_on_from_what_was_found(spark):
    rows = [(i, f"reach us at +1 555 010 {2000 + i} now") for i in range(7)]
    rows += [(10 + i, f"reach us at {70001111 + i} now") for i in range(4)]  # known after the first round
    rows += [(20 + i, f"ring the bell of {70001111 + i} loudly") for i in range(4)] + [(30, "ring the bell of 80009999 loudly")]
    got = spans(frame(spark, rows, SCHEMA))
    assert all(got[10 + i] == [("like_phone", 12, 20)] for i in range(4))
    assert got[30] == [("like_phone", 17, 25)]


def test_copies_of_one_text_prove_nothing(spark):
    rows = [(i, "just one text: call me at +1 555 010 2000 now") for i in range(30)] + [(99, "call me at 70001111 now")]
    assert spans(frame(spark, rows, SCHEMA))[99] == []


def test_edge_rows(spark):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(50, "a@b.cd"), (50, "a@b.cd"), (None, "x 10.0.0.1"), (60, "ü 4111111111111111 " * 3000)]
    got = pii.private_spans(with_clashes(frame(spark, rows, SCHEMA))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"]] == [(pii.KINDS[k], a, b) for k, a, b in plain_spans(r["text"] or "")]
    assert pii.private_spans(frame(spark, [], SCHEMA)).count() == 0


def test_redacted(spark):
    rows = [(1, "é a@b.cd and 10.0.0.1!"), (2, None), (3, "nothing"), (4, "a@1.2.3.4 x")]
    got = {r["doc_id"]: r["text"] for r in pii.redacted(frame(spark, rows, SCHEMA)).collect()}
    assert got == {1: "é [email] and [ip]!", 2: None, 3: "nothing", 4: "[email] x"}
