from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from llm.helpers import EDGE_TEXTS, by_id, frame, prose, with_clashes

from tillhouse.llm import simhash
from tillhouse.llm.frames import components


def fingerprint(text, size=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, radius=2):
    """Brute-force component minimum for {id: fingerprint}."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if bin(prints[i] ^ prints[j]).count("1") <= radius and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    return label


def test_fingerprints_and_components_equal_brute_force(spark):
    texts = EDGE_TEXTS + [prose(s, n) for s in range(12) for n in (1, 2, 3, 4, 60)]
    texts += [prose(3, 900) + f" end{k}" for k in range(25)] + [prose(3, 900).replace("w1 ", "W1\n\n", k) for k in range(5)]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    got = by_id(simhash.near_groups(with_clashes(frame(spark, rows, "doc_id long, text string"))))
    want = {i: fingerprint(t) for i, t in rows}
    assert {i: r["fp"] % 2**64 for i, r in got.items()} == want
    assert {i: r["component_id"] for i, r in got.items()} == roots(want)
    assert len(set(roots(want).values())) < len(rows) - 20


def clustered(n, seed=1):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        base = rng.getrandbits(64)
        for _ in range(20):
            out.add(base)
            for _ in range(rng.randrange(1, 4)):
                base ^= 1 << rng.randrange(64)
    return sorted(out)[:n]


def test_linked_matches_all_pairs_within_groups():
    rng = np.random.default_rng(0)
    fp = np.array(clustered(600), dtype=np.uint64)
    key = np.sort(rng.integers(0, 5, len(fp))).astype(np.int64)
    label = simhash.linked(key, fp)
    for k in range(5):
        own = np.flatnonzero(key == k)
        want = roots({int(i): int(fp[i]) for i in own})
        assert {int(i): int(label[i]) for i in own} == want


def test_hot_keys_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT", 3)
    fp = clustered(120, 3) + [(7 << 40) + (1 << k) for k in range(30)]  # the last share their upper half
    prints = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)), i) for i, x in enumerate(fp)], "fp long, doc_id long")
    got = {r["fp"] % 2**64: r["component_id"] for r in simhash.groups(prints).collect()}
    want = roots(dict(enumerate(fp)))
    assert [got[x] for x in fp] == [want[i] for i in range(len(fp))]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(500, 500), (700, 701), (701, 700)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 500: 500, 700: 700, 701: 700}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_drop_near_copies_leaves_one_of_each_group(spark):
    long = prose(1, 400)
    rows = [(5, long), (3, long), (3, long), (8, prose(2, 400)), (9, None), (4, ""), (None, prose(4, 100)), (None, prose(4, 100))]
    docs = with_clashes(frame(spark, rows, "doc_id long, text string"))
    out = simhash.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect()) == sorted(
        [("3", long), ("8", prose(2, 400)), ("4", ""), ("None", prose(4, 100))]
    )
    assert simhash.drop_near_copies(docs.limit(0)).count() == 0
