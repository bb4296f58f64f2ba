from __future__ import annotations

import random
import re
from itertools import permutations

from llm.helpers import EDGE_TEXTS, frame, prose, with_clashes

from tillhouse.llm import filter_audit as audit

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def fails(text, doc_id, least):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
        doc_id is not None and doc_id > least[text],
    ]


def simulated(docs, labels):
    """Every order run over every document."""
    least: dict = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    marks: dict = {}
    for i, quality, toxic in labels:
        if i is not None:
            good, bad = marks.get(i, (False, False))
            marks[i] = (good or quality == 1, bad or toxic == 1)
    parts: dict = {}
    for i, text, lang in docs:
        parts.setdefault(lang or "", []).append((fails(text or "", i, least), *marks.get(i, (False, False))))
    out = {}
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            alive = [True] * len(rows)
            for step, letter in enumerate(order, 1):
                f = "ABCDE".index(letter)
                hit = [r[0][f] for r in rows]
                gone = [a and h for a, h in zip(alive, hit)]
                redundant = sum(h and not a for a, h in zip(alive, hit))
                alone = sum(h and sum(r[0]) == 1 for h, r in zip(hit, rows))
                alive = [a and not h for a, h in zip(alive, hit)]
                lost = [sum(g and r[k] for g, r in zip(gone, rows)) for k in (1, 2)]
                out[part, order, step] = [sum(alive), sum(gone), redundant, alone, *lost]
                total[letter] += sum(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(docs, labels):
    rows = audit.interactions(audit.masks(docs, labels)).collect()
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in rows}
    assert len(got) == len(rows) and all(r["filter"] == r["filter_order"][r["step"] - 1] for r in rows)
    return got


def test_all_orders_equal_a_simulation(spark):
    rng = random.Random(1)
    texts = [*EDGE_TEXTS, prose(1, 250, 10), prose(2, 250, 5000), prose(3, 250, 5000).upper(), prose(4, 199, 5000), prose(5, 300, 5000) + " 5%", "#"]
    docs = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(200)]
    docs += [(7, "same row", "en")] * 3 + [(500 + i, "shared by many", "fr") for i in range(40)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(80)]
    got = audited(with_clashes(frame(spark, docs, DOCS)), with_clashes(frame(spark, labels, LABELS)))
    assert got == simulated(docs, labels)
    assert got["fr", "EABCD", 1][:2] == [1, 39]


def test_empty_tables(spark):
    none, docs = frame(spark, [], LABELS), [(1, "a b", "en")]
    assert audited(frame(spark, [], DOCS), none) == {}
    assert audited(frame(spark, docs, DOCS), none) == simulated(docs, [])


def test_intervals_follow_the_lehmer_code():
    rows = audit.intervals(3)
    # Mask of the second filter only: it is first in ranks 2 and 3 of the six orders, and never redundant.
    assert [r[1:] for r in rows if r[0] == 2] == [(1, 2, 4, True), (2, 0, 1, True), (2, 5, 6, True), (3, 1, 2, True), (3, 4, 5, True)]
