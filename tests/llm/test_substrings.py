from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from llm.helpers import EDGE_TEXTS, frame, prose, with_clashes

from tillhouse.llm import substrings
from tillhouse.llm.substrings import repeats


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def brute(rows, window):
    least: dict[bytes, int] = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1 if doc is not None else 0):
            body = b" ".join(w[i : i + window])
            least[body] = min(least.get(body, doc), doc)
    out = []
    for doc, text in rows:
        w, gone = words(text), set()
        for i in range(len(w) - window + 1 if doc is not None else 0):
            if least[b" ".join(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus(seed, window):
    """Passages of a bit less to a lot more than a window in many documents, copies, runs of one word, periodic text."""
    rng = random.Random(seed)
    shared = [prose(seed * 50 + k, n, 400) for k, n in enumerate((window - 1, window, window + 1, 2 * window, 5 * window))]
    rows = []
    for i in range(60):
        parts = [prose(rng.randrange(10**6), rng.randrange(1, 3 * window), 400)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), prose(rng.randrange(10**6), rng.randrange(0, window), 400)]
        if rng.random() < 0.2:
            parts.append(" ".join(["run"] * rng.randrange(window, 3 * window)))
        if rng.random() < 0.2:
            parts.append(" ".join(["a b c d e"] * window))
        rng.shuffle(parts)
        rows.append((rng.randrange(200), rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(300 + k, rows[k][1]) for k in range(5)] + [(400, rows[0][1].replace(" ", "\n")), rows[1], rows[1], (None, rows[2][1]), (None, shared[4])]
    return rows + [(500 + i, t) for i, t in enumerate(EDGE_TEXTS * 2)]


@pytest.mark.parametrize("window, size, split", [(50, 10, 8192), (12, 4, 8192), (12, 3, 6)])
def test_equals_brute_force(spark, monkeypatch, window, size, split):
    monkeypatch.setattr(substrings, "SPLIT", split)  # 6: every shared prefix is divided
    rows = corpus(split, window)
    got = repeats(with_clashes(frame(spark, rows, "doc_id long, text string")), window, size).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute(rows, window)
    assert sum(r["n_removed"] > 0 for r in got) > 20


@pytest.mark.parametrize("extra", [0, 1, 20])
def test_passage_twice_in_every_document_of_a_divided_prefix(spark, monkeypatch, extra):
    """Each part's smallest document holds the passage in two rows, and under one id in rows of different texts."""
    monkeypatch.setattr(substrings, "SPLIT", 6)
    passage = prose(9, 12 + extra, 400)
    rows = [(i, f"{prose(10 * i, 15, 400)} {passage} {prose(10 * i + 1, 15, 400)} {passage} {prose(10 * i + 2, 15, 400)}") for i in range(60)]
    rows += [(i, f"{prose(10 * i + 3, 15, 400)} {passage} {prose(10 * i + 4, 15, 400)}") for i in range(0, 60, 3)]
    got = repeats(frame(spark, rows, "doc_id long, text string"), 12, 3).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute(rows, 12)


def test_kept_texts(spark):
    passage = prose(3, 60, 400)
    rows = [(1, f"x {passage} y"), (2, f"start {passage} end"), (3, f"x {passage}  y"), (4, "alone")]
    got = {r["doc_id"]: r["kept"] for r in repeats(frame(spark, rows, "doc_id long, text string"), texts=True).collect()}
    assert got == {1: None, 2: "start end", 3: "", 4: None}


def test_long_document_and_empty_table(spark):
    rows = [(1, prose(1, 40_000, 9000)), (2, prose(1, 40_000, 9000) + " tail"), (3, "tail " * 3)]
    got = repeats(frame(spark, rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute(rows, 50)
    assert repeats(frame(spark, [], "doc_id long, text string")).count() == 0


def test_every_window_has_a_gram_at_the_same_place_in_every_copy():
    import numpy as np

    rng = np.random.default_rng(1)
    for alphabet in (2, 50):
        h = rng.integers(1, 1 + alphabet, 500).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at, _, near, far = substrings.gram_positions(h, np.array([0, 200, 500]), 20, 5)
        covers: dict[int, set] = {}
        for p, lo, hi in zip(at, near, far):
            for k in range(lo, hi + 1):
                covers.setdefault(int(p - k), set()).add(int(k))
        assert sorted(covers) == [*range(0, 181), *range(200, 481)]
        seen: dict[bytes, set] = {}
        for i, ks in covers.items():
            assert seen.setdefault(h[i : i + 20].tobytes(), ks) == ks
