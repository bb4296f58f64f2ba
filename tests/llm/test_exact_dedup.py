from __future__ import annotations

from collections import Counter

from llm.helpers import EDGE_TEXTS, frame, with_clashes

from tillhouse.llm import exact_dedup
from tillhouse.llm.exact_dedup import drop_copies, exact_groups

ROWS = [(i, t) for i, t in enumerate(EDGE_TEXTS * 2)] + [(99, "same"), (98, "same"), (99, "same"), (None, "same"), (None, "lone")]
ROWS += [(200 + i, "p" * 200 + str(i % 3)) for i in range(9)]  # equal length and prefix, different texts


def expected():
    texts: dict = {}
    for i, t in ROWS:
        texts.setdefault(t or "", []).append(i)
    out = []
    for i, t in ROWS:
        ids = texts[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep))
    return Counter(out)


def test_groups_equal_brute_force(spark, monkeypatch):
    docs = frame(spark, ROWS, "doc_id long, text string")
    for bits in (exact_dedup.BITMAP, 6):  # a wide bitmap, and one in which lone texts hit the bits of others
        monkeypatch.setattr(exact_dedup, "BITMAP", bits)
        got = exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept").collect()
        assert Counter(map(tuple, got)) == expected()


def test_drop_copies_keeps_one_row_per_text(spark):
    docs = with_clashes(frame(spark, ROWS, "doc_id long, text string"))
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    assert len(rows) == len({t for _, t in rows}) == len({t or "" for _, t in ROWS})
    assert (99, "same") in rows and (None, "lone") in rows and (208, "p" * 200 + "2") in rows


def test_empty_table(spark):
    docs = frame(spark, [], "doc_id long, text string")
    assert exact_groups(docs).count() == 0 and drop_copies(docs).count() == 0


def test_only_texts_that_share_length_and_prefix_are_hashed(spark, monkeypatch):
    """The refinement does not change with size: lone texts get no full hash, many shared ones do not switch it off."""
    rows = [(i, f"{i}{'x' * (i % 700)}") for i in range(3000)] + [(5000 + i, "p" * 200 + str(i % 40)) for i in range(400)]
    found = exact_dedup._fingerprinted(frame(spark, rows, "doc_id long, text string"))
    hashed = {r["doc_id"] for r in found.where("_full is not null").collect()}
    assert {i for i, _ in rows if i >= 5000} <= hashed and len(hashed) < 600
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1 and "SortMergeJoin" not in plan


def test_very_long_texts(spark):
    rows = [(1, "a" * 3_000_000), (2, "a" * 3_000_000), (3, "a" * 2_999_999 + "b")]
    got = {r["doc_id"]: r["kept"] for r in exact_groups(frame(spark, rows, "doc_id long, text string")).collect()}
    assert got == {1: False, 2: True, 3: True}
