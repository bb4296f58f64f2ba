"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements; inline elements belong to the block they stand in. Each block has features of
its subtree (text, link and tag density, counts), of its own attributes (hashed words of class, id and role), and of
its depth and place among its siblings. Boosted trees give the log-odds that the block belongs to the main text.
Decoding then takes the labelling with the highest total in which every block is outside, main, or cut from the main
text: below main is main or cut, below cut everything is cut. So no text survives inside a block that was dropped, and
nothing is main twice.

The trees are fitted on a bounded sample: at most ``MAX_PAGES`` pages (smallest hashes of the html) and ``PAGE_BLOCKS``
blocks of each, drawn by hash over the whole page; about 40,000 blocks of 1.3 kB reach the driver. No page is labelled by
hand: the landmarks of pages that have them (``article``, ``main``; menus, asides, forms, comment lists by element or
attribute) are the labels. A model of pages that are all alike would know their layout only, so each page is learned from
in three forms: as it is; with its own menus, adverts and footers, and some of its own paragraphs wrapped in elements
marked as asides, grafted into and beside its article, where they are cut as well; and, half of all rows, with all landmark elements turned to ``div`` and all attributes gone, which leaves looks to judge
by. That a block stands in something marked as an aside is a feature; that it stands in an article is not. Without any
landmark in the sample a text-density prior decides.

Null and empty html, and pages without text, give the empty text. Pages are independent: repeated rows come out
repeated, an empty table gives no rows. Blocks are joined by a line feed in page order, white space within a block is
one space, character references are decoded. Nesting may have any depth, pages any length. Extra columns are carried
along if asked for; the new column gets a name that none of them has.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.boosting import Boosted, fitted
from tillhouse.llm.frames import appended, fresh_name, smallest, stored

MAX_PAGES, PAGE_BLOCKS = 1000, 40
HASHED = 128  # buckets of attribute words

# Element names of HTML by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style template noscript head title iframe object svg math canvas audio video select datalist".split())
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
PARAGRAPHS = ["p", "pre", "blockquote", "figcaption", "dd", "dt", "summary", *HEADINGS]
BLOCKS = set(PARAGRAPHS) | set(
    "html body main article section div header footer nav aside form fieldset address figure details dialog ul ol li dl "
    "table caption thead tbody tfoot tr td th center menu search hgroup".split()
)
#: Elements that end an open paragraph; list items and cells also end their like.
ENDS_PARAGRAPH = BLOCKS - {"html", "body"}
ENDS_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = set("ul ol dl table article section div main body html form aside nav".split())
MAIN_MARKS = {"article", "main"}
ASIDE_TAGS = {"nav", "aside", "footer", "form", "menu", "dialog", "search"}
ASIDE_WORDS = set(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb breadcrumbs sidebar "
    "side aside widget footer comment comments reply replies respond discussion disqus reader share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login cookie cookies consent notice notices alert popup modal toolbar pagination pager".split()
)
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_TAGS = ["p", "div", "li", "ul", "section", "article", "main", "nav", "aside", "header", "footer", "form", "td", "blockquote", "body", *HEADINGS[:3]]


class Block:
    __slots__ = (
        "tag", "words", "parent", "children", "parts", "links", "inline", "depth", "place", "paragraphs", "aside",
        "chars", "link_chars", "blocks", "tags", "stops", "runs",
    )

    def __init__(self, tag: str, words: frozenset, parent: Block | None):
        self.tag, self.words, self.parent = tag, words, parent
        self.children: list[Block] = []
        self.parts: list = []  # own text and child blocks, in page order
        self.links = self.inline = 0
        self.depth = parent.depth + 1 if parent else 0
        self.place = self.paragraphs = 0  # index among the siblings, number of paragraph children


def attribute_words(attributes) -> frozenset:
    found = [v for k, v in attributes if k in ("class", "id", "role", "itemprop") and v]
    return frozenset(w.lower() for v in found for part in _CAMEL.split(v) for w in _WORD.findall(part))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Block("html", frozenset(), None)
        self.all = [self.root]
        self.open: list[tuple[str, Block | None]] = []  # elements, with their block if they are one
        # Where in ``open`` the elements of each name, those of ``SCOPES`` and those with a block are: nothing is searched.
        self.at: defaultdict[str, list[int]] = defaultdict(list)
        self.scopes: list[int] = []
        self.blocks: list[int] = []
        self.silent: list[str] = []
        self.in_link = 0

    def handle_starttag(self, tag, attrs):
        if self.silent == ["head"] and tag in BLOCKS:
            self.silent.clear()  # the head's end tag is optional
        if self.silent:
            if tag in SILENT:
                self.silent.append(tag)
            return
        if tag in SILENT:
            self.silent.append(tag)
            return
        if tag in VOID:
            if tag in ("br", "hr"):
                self.here.parts.append(" ")
            self.here.inline += 1
            return
        if tag in ENDS_PARAGRAPH:
            self.implied(tag)
        if tag in ("html", "body") and self.at[tag]:
            return
        block = None
        if tag in BLOCKS:
            block = Block(tag, attribute_words(attrs), self.here)
            self.here.parts.append(block)
            self.here.children.append(block)
            self.all.append(block)
            self.here = block
        else:
            self.here.inline += 1
            if tag == "a":
                self.in_link += 1
        for places in self.listed(tag, block):
            places.append(len(self.open))
        self.open.append((tag, block))

    def listed(self, tag, block):
        return [self.at[tag], *([self.scopes] if tag in SCOPES else []), *([self.blocks] if block is not None else [])]

    def implied(self, tag):
        """Ends an open paragraph or list item that this element cannot stand in."""
        scope = self.scopes[-1] if self.scopes else -1
        if tag not in ENDS_LIKE:
            if self.at["p"] and self.at["p"][-1] > scope:
                self.end_from(self.at["p"][-1])
            return
        inside = []
        for places in (self.at[name] for name in ("p", *ENDS_LIKE[tag])):
            first = bisect_right(places, scope)
            inside += places[first : first + 1]
        if inside:
            self.end_from(min(inside))

    def end_from(self, k):
        while len(self.open) > k:
            name, block = self.open.pop()
            for places in self.listed(name, block):
                places.pop()
            if block is not None:
                self.here = block.parent
            elif name == "a":
                self.in_link -= 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in SILENT and self.silent:
            self.silent.pop()

    def handle_endtag(self, tag):
        if self.silent:
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
            elif tag in ("body", "html"):
                self.silent.clear()
            return
        own = self.at[tag][-1] if self.at[tag] else -1
        block = self.blocks[-1] if self.blocks else -1
        if own >= 0 and (tag in BLOCKS or own > block):  # an inline end tag does not reach out of its block
            self.end_from(own)

    def handle_data(self, data):
        if not self.silent:
            self.here.parts.append(data)
            if self.in_link:
                self.here.links += len(data)


def parse(html: str) -> list[Block]:
    """All blocks in page order; the first is the root."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.all


PLAIN = 26
FEATURES = PLAIN + len(_TAGS) + 2 * HASHED


def marked_aside(b: Block) -> bool:
    return b.tag in ASIDE_TAGS or bool(b.words & ASIDE_WORDS)


def block_features(blocks: list[Block]) -> np.ndarray:
    for b in blocks:
        own = _SPACE.sub(" ", "".join(x for x in b.parts if isinstance(x, str))).strip()
        b.chars, b.link_chars, b.blocks, b.tags = len(own), b.links, 1, 1 + b.inline
        b.stops, b.runs = sum(own.count(c) for c in ".,!?;:"), int(bool(own))
        b.paragraphs = sum(c.tag in PARAGRAPHS for c in b.children)
        b.aside = marked_aside(b) or (b.parent is not None and b.parent.aside)
        for k, c in enumerate(b.children):
            c.place = k
    own = [(b.chars, b.link_chars, b.stops) for b in blocks]
    for b in reversed(blocks):
        if b.parent is not None:
            up = b.parent
            up.chars += b.chars
            up.link_chars += b.link_chars
            up.blocks += b.blocks
            up.tags += b.tags
            up.stops += b.stops
            up.runs += b.runs
    total = max(1, blocks[0].chars)
    out = np.zeros((len(blocks), FEATURES), dtype=np.float32)
    seen = 0
    for i, b in enumerate(blocks):
        up = b.parent
        beside = len(up.children) if up else 1
        row = [
            np.log1p(b.chars), b.chars / total, b.link_chars / max(1, b.chars), b.chars / b.tags, b.chars / b.blocks,
            b.stops / max(1, b.chars), b.runs, np.log1p(own[i][0]), own[i][1] / max(1, own[i][0]), own[i][2], b.depth,
            b.place, beside, b.place / beside, len(b.children), b.paragraphs, seen / total, len(b.words),
            np.log1p(up.chars) if up else 0, up.link_chars / max(1, up.chars) if up else 0, b.chars / max(1, up.chars) if up else 1,
            up.paragraphs if up else b.tag in PARAGRAPHS, b.tag in PARAGRAPHS, np.log1p(b.tags), b.aside, marked_aside(b),
        ]
        out[i, : len(row)] = row
        if b.tag in _TAGS:
            out[i, PLAIN + _TAGS.index(b.tag)] = 1
        for at, words in ((PLAIN + len(_TAGS), b.words), (PLAIN + len(_TAGS) + HASHED, up.words if up else ())):
            for w in words:
                out[i, at + zlib.crc32(w.encode()) % HASHED] = 1
        seen += own[i][0]
    return out


def landmark_labels(blocks: list[Block]) -> np.ndarray | None:
    """1 main, 0 not, by landmarks alone; None for a page without a main landmark."""
    if not any(b.tag in MAIN_MARKS or "main" in b.words and b.tag == "div" for b in blocks):
        return None
    inside, label = {}, np.zeros(len(blocks))
    for i, b in enumerate(blocks):
        state = inside[id(b.parent)] if b.parent is not None else 0
        if marked_aside(b) or b.tag == "header" and not state:
            state = -1
        elif state == 0 and (b.tag in MAIN_MARKS or "main" in b.words and b.tag == "div"):
            state = 1
        inside[id(b)] = state
        label[i] = state == 1
    return label


def _copied(root: Block, parent: Block) -> Block:
    copies = {}
    stack = [(root, parent)]
    while stack:
        block, up = stack.pop()
        copy = copies[id(block)] = Block(block.tag, block.words, up)
        copy.links, copy.inline, copy.parts = block.links, block.inline, list(block.parts)
        stack += [(c, copy) for c in block.children]
    for copy in copies.values():
        copy.parts = [x if isinstance(x, str) else copies[id(x)] for x in copy.parts]
        copy.children = [x for x in copy.parts if not isinstance(x, str)]
    return copies[id(root)]


def _wrapped(parts: list[Block], host: Block, rng: np.random.Generator) -> Block:
    """Copies of these blocks in an element that is marked as an aside, one list item each or bare."""
    tag, word = rng.choice(["aside", "form", "div", "section", "ul"]), rng.choice(sorted(ASIDE_WORDS))
    out = Block(str(tag), frozenset() if tag in ASIDE_TAGS else frozenset([str(word)]), host)
    for part in parts:
        holder = Block("li", frozenset(), out) if tag == "ul" else out
        holder.parts.append(_copied(part, holder))
        holder.children = [x for x in holder.parts if not isinstance(x, str)]
        if holder is not out:
            out.parts.append(holder)
    out.children = [x for x in out.parts if not isinstance(x, str)]
    return out


def grafted(blocks: list[Block], label: np.ndarray, seed: int) -> tuple[list[Block], np.ndarray]:
    """The page with asides in its main text, copied from its own or made of its own paragraphs; changes the tree."""
    rng = np.random.default_rng(seed)
    main = [b for b, y in zip(blocks, label) if y]
    host = next((b for b in main if len(b.children) > 1), main[0] if main else None)
    if host is None:
        return blocks, label
    known = {id(b): y for b, y in zip(blocks, label)}
    own = [b for b in blocks if marked_aside(b) and not (b.parent is not None and marked_aside(b.parent))]
    texts = [b for b in host.children if known[id(b)]]
    made = [_copied(own[k], host) for k in rng.integers(len(own), size=2)] if own else []
    made += [_wrapped([texts[k] for k in rng.integers(len(texts), size=rng.integers(1, 5))], host, rng) for _ in range(2)] if texts else []
    for block in made:
        host.parts.insert(int(rng.integers(len(host.parts) + 1)), block)
    places = [host]
    if texts and host.parent is not None:  # one beside the main text as well
        host.parent.parts.append(_wrapped([texts[int(rng.integers(len(texts)))]], host.parent, rng))
        places.append(host.parent)
    for place in places:
        place.children = [x for x in place.parts if not isinstance(x, str)]
    order, stack = [], [blocks[0]]
    while stack:
        order.append(stack.pop())
        stack += reversed(order[-1].children)
    return order, np.array([known.get(id(b), 0.0) for b in order])


def hidden(blocks: list[Block]) -> list[Block]:
    """The page without landmarks: their elements are ``div``, attributes are gone; changes the tree."""
    for b in blocks:
        b.words = frozenset()
        if b.tag in MAIN_MARKS | ASIDE_TAGS | {"header", "section"}:
            b.tag = "div"
    return blocks


def drawn(n: int, limit: int, seed: int) -> np.ndarray:
    """At most ``limit`` of ``n`` numbers, evenly over all of them, the same for the same seed."""
    return np.arange(n) if n <= limit else np.sort(np.random.default_rng(seed).choice(n, limit, replace=False))


def lessons(html: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Features and labels of drawn blocks of a page in its three forms; None without landmarks."""
    seed = zlib.crc32(html.encode("utf-8", "surrogatepass"))
    label = landmark_labels(parse(html))
    if label is None:
        return None
    forms = [(parse(html), label, PAGE_BLOCKS // 4), (*grafted(parse(html), label, seed), PAGE_BLOCKS // 4), (hidden(parse(html)), label, PAGE_BLOCKS // 2)]
    xs, ys = [], []
    for blocks, y, limit in forms:
        chosen = drawn(len(blocks), limit, seed)
        xs.append(block_features(blocks)[chosen])
        ys.append(y[chosen])
    return np.concatenate(xs), np.concatenate(ys)


def decode(blocks: list[Block], logits: np.ndarray) -> np.ndarray:
    """The best labelling: outside may hold main, main may hold cut, nothing else is held."""
    index = {id(b): i for i, b in enumerate(blocks)}
    n = len(blocks)
    outside, main, cut = -logits.copy(), logits.copy(), -logits.copy()
    for i in range(n - 1, 0, -1):
        up = index[id(blocks[i].parent)]
        outside[up] += max(outside[i], main[i])
        main[up] += max(main[i], cut[i])
        cut[up] += cut[i]
    keep = np.zeros(n, dtype=bool)
    dropped = np.zeros(n, dtype=bool)
    for i, b in enumerate(blocks):
        up = index[id(b.parent)] if b.parent is not None else -1
        if up >= 0 and dropped[up]:
            dropped[i] = True
        elif up >= 0 and keep[up]:
            keep[i], dropped[i] = main[i] >= cut[i], main[i] < cut[i]
        else:
            keep[i] = main[i] > outside[i]
    return keep


def kept_text(blocks: list[Block], keep: np.ndarray) -> str:
    """Text of kept blocks; each stretch between block borders is a block of its own."""
    kept = {id(b) for b, k in zip(blocks, keep) if k}
    lines: list[str] = []
    stack = [(blocks[0], iter(blocks[0].parts), [])]
    while stack:
        block, parts, run = stack[-1]
        part = next(parts, None)
        if isinstance(part, str):
            run.append(part)
            continue
        if run and id(block) in kept:
            line = _SPACE.sub(" ", "".join(run)).strip()
            if line:
                lines.append(line)
        run.clear()
        if part is None:
            stack.pop()
        else:
            stack.append((part, iter(part.parts), []))
    return "\n".join(lines)


def prior(blocks: list[Block], x: np.ndarray) -> np.ndarray:
    """Log-odds by text density, for a sample without landmarks."""
    return np.where((x[:, 4] > 60) & (x[:, 2] < 0.4) & (x[:, 15] + x[:, 22] > 0), 2.0, -1.0)


def train(pages: DataFrame, html: str = "html", limit: int = MAX_PAGES) -> Boosted | None:
    """Fits on at most ``limit`` pages; ``PAGE_BLOCKS`` blocks of each, features and labels, reach the driver (50 MB)."""
    hashes = pages.select(F.xxhash64(html).alias("hash")).where(F.col(html).isNotNull()).groupBy("hash").count()
    chosen = smallest(stored(hashes.select("hash"), "html-hashes"), F.col("hash"), limit)  # narrow rows only
    rows = pages.select(html).join(F.broadcast(chosen), F.xxhash64(html) == F.col("hash"))
    chosen = rows.groupBy("hash").agg(F.first(html).alias(html))  # of a page that many rows share, one a task travels
    chosen = stored(chosen.repartition(8, "hash"), "html-sample")

    def labelled(batches):
        for batch in batches:
            xs, ys = [], []
            for page in batch.column(html).to_pylist():
                found = lessons(page)
                if found is not None:
                    xs.append(found[0])
                    ys.append(found[1])
            if xs:
                x, y = np.concatenate(xs), np.concatenate(ys)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["x", "y"])

    rows = chosen.mapInArrow(labelled, "x binary, y binary").collect()
    if not rows:
        return None
    x = np.concatenate([np.frombuffer(r["x"], dtype=np.float32).reshape(-1, FEATURES) for r in rows])
    y = np.concatenate([np.frombuffer(r["y"], dtype=np.float64) for r in rows])
    order = np.lexsort(np.concatenate([x.T, y[None]]))
    x, y = x[order], y[order]
    if not 0 < y.sum() < len(y):
        return None
    return fitted(x, y, 0.2 + x[:, 7])  # blocks weigh by the text they hold


def main_text(html: str | None, model: Boosted | None) -> str:
    if not html:
        return ""
    blocks = parse(html)
    x = block_features(blocks)
    return kept_text(blocks, decode(blocks, prior(blocks, x) if model is None else model.logits(x)))


def extracted(pages: DataFrame, model: Boosted | None, html: str = "html", carry: list[str] | None = None, name: str = "text") -> DataFrame:
    """``carry`` columns (all by default) with the main text in column ``name``."""
    carry = pages.columns if carry is None else carry
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value

        def work(batch: pa.RecordBatch) -> list:
            trees, xs = [], []
            out: list[str] = []

            def flush():
                if trees:
                    x = np.concatenate(xs)
                    logits = own.logits(x) if own is not None else np.concatenate([prior(b, f) for b, f in zip(trees, xs)])
                    at = 0
                    for blocks in trees:
                        out.append(kept_text(blocks, decode(blocks, logits[at : at + len(blocks)])))
                        at += len(blocks)
                    trees.clear()
                    xs.clear()

            size = 0
            for page in batch.column(html):
                body = page.as_py() or ""
                trees.append(parse(body))
                xs.append(block_features(trees[-1]))
                size += len(body)
                if size > 1 << 20:
                    flush()
                    size = 0
            flush()
            return [pa.array(out, pa.string())]

        return work

    return appended(pages, carry, [(fresh_name(carry, name), "string")], start)
