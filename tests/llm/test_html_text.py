from __future__ import annotations

import random
import re
from itertools import product

import numpy as np
from llm.helpers import frame, prose, with_clashes

from tillhouse.llm import html_text as H
from tillhouse.llm.boosting import fitted


def sentences(seed, n):
    return " ".join(f"{prose(seed * 100 + i, 9).capitalize()}, indeed." for i in range(n))


def page(seed, marks=True):
    """A page and its main text: with landmarks, or of plain divs with telling classes only."""
    rng = random.Random(seed)
    blocks = [f"Title {seed} &amp; more", *(sentences(seed * 7 + k, rng.randrange(2, 6)) for k in range(rng.randrange(2, 7)))]
    links = "".join(f'<li><a href="/{k}">{prose(k, 2)}</a></li>' for k in range(8))
    body = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b.replace('indeed', '<i>indeed</i>', 1)}</p>" for b in blocks[1:])
    comments = f'<div class="comments"><h3>Comments</h3><p>{prose(seed, 8)}</p></div>'
    form = "<form><label>Mail</label><input><button>Send</button></form>"
    if marks:
        inner = f'<article>{body}{comments}</article><aside class="sidebar"><p>{prose(3, 9)}</p></aside>'
        page = f'<nav class="menu"><ul>{links}</ul></nav>{inner}{form}<footer><p>(c) {seed}</p></footer>'
    else:
        page = f'<div class="menu"><ul>{links}</ul></div><div class="content">{body}{comments}</div>{form}<div class="footer"><p>(c) {seed}</p></div>'
    html = f"<!doctype html><html><head><title>no</title><script>var a='<p>no</p>';</script></head><body>{page}</body></html>"
    return html, "\n".join(re.sub("&amp;", "&", b) for b in blocks)


ODD = [None, "", "   ", "plain text", "<p>one<p>two", "<article>a<br>b <b>c<p>d</article>", "<", "</p></div>", "<div>" * 3000 + "x" * 100]


def test_landmark_pages_and_odd_pages(spark):
    pages = [(i, *page(i)) for i in range(60)]
    rows = [(i, f"u{i}", html) for i, html, _ in pages] + [(1000 + i, "u", x) for i, x in enumerate(ODD)] + [(2, "u2", pages[2][1])]
    df = with_clashes(frame(spark, rows, "page_id long, url string, html string"))
    got = H.extracted(df, H.train(df)).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert all(text[i] == want for i, _, want in pages)
    assert text[1000] == text[1001] == text[1002] == "" and text[1005] == "a b c\nd"


def test_pages_without_landmarks_are_judged_by_their_looks(spark):
    marked = [(i, "u", page(i)[0]) for i in range(60)]
    bare = [(i, *page(i, False)) for i in range(100, 130)]
    model = H.train(frame(spark, marked, "page_id long, url string, html string"))
    assert model is not None
    found = [H.main_text(html, model).split("\n") for _, html, _ in bare]
    wanted = [want.split("\n") for _, _, want in bare]
    hits = sum(len(set(a) & set(b)) for a, b in zip(found, wanted))
    assert hits / sum(map(len, wanted)) > 0.9 and hits / sum(map(len, found)) > 0.8


def test_no_landmarks_at_all_and_empty_table(spark):
    df = frame(spark, [(i, "u", page(i, False)[0]) for i in range(5)], "page_id long, url string, html string")
    assert H.train(df) is None
    assert all(r["text"] for r in H.extracted(df, None).collect())
    assert H.train(df.limit(0)) is None and H.extracted(df.limit(0), None).count() == 0


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(3)
    for _ in range(60):
        blocks = [H.Block("html", frozenset(), None)]
        for _ in range(6):
            up = blocks[rng.integers(len(blocks))]
            blocks.append(H.Block("div", frozenset(), up))
        order = {id(b): i for i, b in enumerate(blocks)}
        logits = rng.normal(size=len(blocks))
        best, choice = -np.inf, None
        for states in product("OMC", repeat=len(blocks)):  # outside, main, cut
            good = states[0] != "C" and all(
                (states[order[id(b.parent)]], s) in {("O", "O"), ("O", "M"), ("M", "M"), ("M", "C"), ("C", "C")} for b, s in zip(blocks[1:], states[1:])
            )
            value = sum(v if s == "M" else -v for v, s in zip(logits, states))
            if good and value > best:
                best, choice = value, states
        assert [s == "M" for s in choice] == H.decode(blocks, logits).tolist()


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.3)).astype(float)
    model = fitted(x[:1500], y[:1500], np.ones(1500))
    assert ((model.logits(x[1500:]) > 0) == y[1500:]).mean() > 0.95


def test_given_pages_match_their_article(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in H.extracted(df, H.train(df)).collect():
        body = r["html"].partition("<article>")[2].partition("</article>")[0]
        parts = [re.sub(r"\s+", " ", re.sub(r"<br>", " ", p.replace("<b>", ""))).strip() for p in re.split(r"</?p>|</?h1>", body)]
        if "&" not in body and not re.search(r"<(?!/?(p|h1|b|br)>)", body):
            assert r["text"] == "\n".join(p.replace("</b>", "") for p in parts if p.replace("</b>", "").strip())


def test_sibling_features_of_long_lists_and_articles():
    """Place, number of siblings and of paragraphs among them are true counts, whatever their number."""
    items = "".join(f"<li>{k}</li>" for k in range(100))
    text = "".join(f"<p>{k}</p>" if k % 3 else f"<div>{k}</div>" for k in range(300))
    blocks = H.parse(f"<body><ul>{items}</ul><article>{text}</article></body>")
    x = H.block_features(blocks)
    for tag, n, paragraphs in (("ul", 100, 0), ("article", 300, 200)):
        own = [i for i, b in enumerate(blocks) if b.parent is not None and b.parent.tag == tag]
        assert x[own, 11].tolist() == list(range(n)) and set(x[own, 12]) == {n}
        assert np.allclose(x[own, 13], np.arange(n) / n) and set(x[own, 21]) == {paragraphs}


def test_deep_nesting_keeps_block_borders_and_cuts():
    """A thousand levels around and inside the article; a menu and an advert at the bottom are cut, the rest is kept."""
    outer = "".join(f"<{('div', 'ul', 'blockquote')[k % 3]}>" for k in range(1000))
    inner = "".join(f"<div>a{k} <b>b</b>" for k in range(1000))
    deep = "<nav>menu</nav><p>one<p>two<div class='advert'><p>buy</p></div><ul><li>three<li>four</ul>"
    blocks = H.parse(f"{outer}<p>before</p><article>{inner}{deep}{'</div>tail' * 1000}</article>after")
    want = [*(f"a{k} b" for k in range(1000)), "one", "two", "three", "four", *["tail"] * 1000]
    assert H.kept_text(blocks, H.decode(blocks, 2 * H.landmark_labels(blocks) - 1)).split("\n") == want
    every = H.kept_text(blocks, np.ones(len(blocks), dtype=bool)).split("\n")
    assert every == ["before", *want[:1000], "menu", "one", "two", "buy", *want[1002:], "after"]
    assert max(b.depth for b in blocks) > 2000 and len(H.block_features(blocks)) == len(blocks)


def test_unclosed_and_unmatched_tags_take_linear_time():
    n = 40_000
    blocks = H.parse("<p><body>" + "<blockquote>q" * n + "</x></section></i>" * n + "<div><i>" * n + "</b>" * n)
    assert len(blocks) == 2 * n + 3
    assert H.kept_text(blocks, np.ones(len(blocks), dtype=bool)).count("q") == n


def given_model(spark, sf_dir):
    return H.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def unseen(seed, style):
    """Layouts the given pages do not have: asides inside the article, or divs only; and their main text."""
    rng = random.Random(seed)
    blocks = [f"Heading {seed}", *(sentences(seed * 7 + k, rng.randrange(3, 7)) for k in range(rng.randrange(3, 7)))]
    links = "".join(f'<li><a href="/{k}">{prose(k, 2)}</a></li>' for k in range(8))
    listed = "".join(f"<li><p>{prose(seed + k, 12).capitalize()}.</p></li>" for k in range(rng.randrange(2, 9)))
    advert = f'<aside class="ad"><p>{prose(seed, 9).capitalize()}.</p></aside>' if style == "marked" else f'<div class="advert"><p>{prose(seed, 9)}.</p></div>'
    comments = f'<div class="comments"><h3>Comments</h3><ul>{listed}</ul></div>'
    form = f"<form><p>{prose(seed, 5)}</p><label>Mail</label><input></form>"
    parts = [f"<p>{b}</p>" for b in blocks[1:]]
    parts.insert(rng.randrange(1, len(parts)), advert)
    inner = f"<h1>{blocks[0]}</h1>" + "".join(parts) + form + comments
    if style == "marked":
        body = f"<nav><ul>{links}</ul></nav><article>{inner}</article><footer>(c) {seed}</footer>"
    else:
        body = f'<div class="menu"><ul>{links}</ul></div><div class="content">{inner}</div><div class="footer"><p>(c) {seed} {prose(seed, 6)}</p></div>'
    return f"<html><body>{body}</body></html>", blocks


def test_unseen_layouts_under_the_model_of_the_given_pages(spark, sf_dir):
    model = given_model(spark, sf_dir)
    assert model is not None
    for style in ("marked", "divs"):
        pages = [unseen(k, style) for k in range(40)]
        found = [H.main_text(html, model).split("\n") for html, _ in pages]
        hits = sum(len(set(a) & set(b)) for a, (_, b) in zip(found, pages))
        assert hits / sum(len(b) for _, b in pages) >= 0.9, style
        assert hits / sum(map(len, found)) >= 0.9, style


def test_what_reaches_the_driver_is_bounded():
    page = "<nav><ul>" + "<li>x</li>" * 500 + "</ul></nav><article>" + "<p>text, more text.</p>" * 5000 + "</article>"
    x, y = H.lessons(page)
    assert x.shape == (H.PAGE_BLOCKS, H.FEATURES) and len(y) == H.PAGE_BLOCKS and 0 < y.sum() < len(y)
    assert H.MAX_PAGES * H.PAGE_BLOCKS * (H.FEATURES * 4 + 8) < 60e6
    assert H.lessons("<p>no landmark</p>") is None


def test_grafted_and_hidden_pages():
    html = "<nav><ul><li>menu</ul></nav><div class='ad'>buy</div><article><h1>t</h1><p>one</p><p>two</p></article>"
    label = H.landmark_labels(H.parse(html))
    blocks, y = H.grafted(H.parse(html), label, 3)
    assert y.sum() == label.sum() and len(blocks) > len(label)
    inside = [b for b in blocks if b.parent is not None and b.parent.tag == "article" and H.marked_aside(b)]
    assert inside and H.kept_text(blocks, y > 0) == "t\none\ntwo"
    bare = H.hidden(H.parse(html))
    assert not any(H.marked_aside(b) or b.tag == "article" for b in bare) and len(bare) == len(label)
