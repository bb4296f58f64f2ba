from __future__ import annotations

import re

from llm.helpers import EDGE_TEXTS, by_id, frame, prose, with_clashes

from tillhouse.llm import decontaminate
from tillhouse.llm.decontaminate import contamination, cut_contaminated, drop_contaminated

PASSAGE = "The quick brown fox jumps over the lazy dog while eleven more foxes look on"
ITEMS = [(2, PASSAGE), (10, PASSAGE.upper() + "!"), (3, "Kürz, item"), (4, None), (5, "..."), (None, "no id here"), (6, prose(9, 12))]
DOCS = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [
    (50, f"start, {PASSAGE}. End"),
    (51, PASSAGE.replace(" ", "-\n")),
    (52, " ".join(PASSAGE.split()[:9])),
    (53, "kürz ITEM and kürz item"),
    (54, "there is NO id HERE"),
    (55, prose(9, 12) + " " + PASSAGE),
    (55, prose(9, 12) + " " + PASSAGE),
]


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(text, n=10):
    w, hit, items = words(text), set(), set()
    for item, body in ITEMS:
        b = words(body)
        size = min(n, len(b))
        for i in range(len(b) - size + 1 if size else 0):
            for j in range(len(w) - size + 1):
                if w[j : j + size] == b[i : i + size]:
                    hit.update(range(j, j + size))
                    if item is not None:
                        items.add(str(item))
    return len(w), len(hit), sorted(items)


def test_hits_equal_brute_force(spark, monkeypatch):
    docs = with_clashes(frame(spark, DOCS, "doc_id long, text string"))
    bench = frame(spark, ITEMS, "item_id long, text string")
    for words_per_block in (decontaminate.BLOCK_WORDS, 20):  # one block, then several
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words_per_block)
        got = contamination(docs, bench).collect()
        assert len(got) == len(DOCS)
        for r in got:
            assert (r["leak"]["n_words"], r["leak"]["n_hit"], r["leak"]["items"]) == expected(r["text"]), r["text"]


def test_drop_and_cut(spark):
    docs = with_clashes(frame(spark, DOCS, "doc_id long, text string"))
    bench = frame(spark, ITEMS, "item_id long, text string")
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in enumerate(EDGE_TEXTS)} | {52}
    cut = by_id(cut_contaminated(docs, bench))
    assert cut[50]["text"] == "start, . End" and cut[53]["text"] == " and " and cut[52]["text"] == " ".join(PASSAGE.split()[:9])
    assert cut[0]["text"] is None


def test_empty_tables(spark):
    docs = frame(spark, DOCS, "doc_id long, text string")
    bench = frame(spark, ITEMS, "item_id long, text string")
    assert contamination(docs.limit(0), bench).count() == 0
    assert {r["leak"]["n_hit"] for r in contamination(docs, bench.limit(0)).collect()} == {0}


def test_blocks_are_bounded_for_a_huge_item_and_many_copies(spark, monkeypatch):
    """Items are cut into pieces of whole windows, equal ones count once; the hits are the same."""
    huge = prose(5, 900, 5000)
    items = [(1, huge)] + [(2, prose(6, 40, 5000))] * 50 + [(3, "short one"), (None, prose(7, 12, 5000))]
    words_of = huge.split()
    docs = [(1, " ".join(words_of[395:420])), (2, " ".join(words_of[:9])), (3, prose(6, 40, 5000)), (4, "a short ONE b"), (5, " ".join(words_of)), (6, prose(7, 12, 5000))]
    df, bench = frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string")
    whole = {r["doc_id"]: r["leak"] for r in contamination(df, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 200)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 30)
    sizes = []
    real = decontaminate.WindowSet.__init__

    def counted(self, listed, n):
        sizes.append(sum(len(text.split()) for _, text in listed))
        real(self, listed, n)

    monkeypatch.setattr(decontaminate.WindowSet, "__init__", counted)
    cut = {r["doc_id"]: r["leak"] for r in contamination(df, bench).collect()}
    assert cut == whole and whole[5]["n_hit"] == 900 and whole[2]["n_hit"] == 0 and whole[3]["items"] == ["2"] and whole[6]["n_hit"] == 12
    assert len(sizes) > 5 and max(sizes) < 500
