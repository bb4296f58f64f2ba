"""Personal data: patterns for e-mail, IP, card and phone, and bootstrapped contextual extraction of what they miss.

One pass over whole texts finds the base spans, which are the seeds, and every other token that looks like an identifier
(four digits or an ``@``; neighbouring numeric tokens are one). Each of these mentions fills the slots of three lexical
patterns: the two and the three words before it, and the word on each side; a label written together with it (``mail=``)
is a fourth. Patterns and instances (what fills a slot)
make a graph of distinct edges, which Spark scores in rounds:

* a pattern's confidence for a kind is the scores of its instances added up, divided by all its instances; it is accepted
  from ``MIN_CONFIDENCE`` and ``MIN_SUPPORT`` on, the latter counted in different instances, so copies of a text prove
  nothing;
* an instance that is no seed scores 1 - product(1 - confidence) over its accepted patterns and is known from
  ``MIN_SCORE`` on; known instances take part in the next round with their score.

Rounds end when nothing new is known. Mentions of known instances become spans of kinds ``like_email`` to ``like_phone``,
the kind with the largest score. Base spans are never changed or dropped; found ones never overlap them.

Texts do not travel. The graph holds hashes, one row per different (pattern, instance), counted with map-side combine;
patterns with fewer than ``MIN_SUPPORT`` instances are dropped first, which changes no result. Joins have one side with
unique keys, so a common word or a common identifier is split by the skew rule. Patterns and instances are named by 64-bit
hashes, not verified on bytes; base spans use none.

Every step is linear in a text's length. Null and empty texts have no spans; repeated rows come out repeated; an empty
table gives no rows. Extra columns are carried along if asked for. Spans are code points, end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import text as T
from tillhouse.llm.frames import appended, fresh_name, small_or_shuffled, stored

# Kinds in report order, what their matches consist of, and their limits.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MAX_PART, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)

#: All kinds in report order: base kinds, then what contexts found.
ALL_KINDS = KINDS + [f"like_{kind}" for kind in KINDS]
#: Digits of an identifier without ``@``; instances and confidence that a pattern needs; score that an instance needs.
MIN_DIGITS, MIN_SUPPORT, MIN_CONFIDENCE, MIN_SCORE = 4, 3, 0.6, 0.6

_EDGES = " .,;:!?\"'()[]{}<>*#$%&|=/\\"
_NUMERIC = T.byte_class(lambda b: chr(b) in "0123456789()+./-,")
_DIGIT = re.compile("[0-9]+")
_NOT_DIGIT = re.compile("[^0-9]+")


def _emails(body: str) -> list[tuple[int, int]]:
    out, floor = [], 0
    at = body.find("@")
    while at >= 0:
        before = body[floor:at]
        local = len(before) - len(before.rstrip(LOCAL))
        match = DOMAIN.match(body, at + 1) if local else None
        if match:
            out.append((at - local, match.end()))
        floor = match.end() if match else at + 1
        at = body.find("@", floor)
    return out


def _ips(body: str) -> list[tuple[int, int]]:
    out = []
    for match in DOTTED.finditer(body):
        parts, at = match[0].split("."), match.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= MAX_PART for p in four):
                out.append((at, end))
            at = end + 1
    return out


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _cards(body: str) -> list[tuple[int, int]]:
    out = []
    for match in CARD.finditer(body):
        digits = _NOT_DIGIT.sub("", match[0])
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and _luhn(digits):
            out.append(match.span())
    return out


def _phones(body: str) -> list[tuple[int, int]]:
    spans = (m.span() for m in PHONE.finditer(body))
    return [(a, b) for a, b in spans if PHONE_DIGITS[0] <= len(_NOT_DIGIT.sub("", body[a:b])) <= PHONE_DIGITS[1]]


def base_spans(body: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    return [(k, a, b) for k, find in enumerate((_emails, _ips, _cards, _phones)) for a, b in find(body)]


def _word(word: str) -> str:
    return _DIGIT.sub("0", word.strip(_EDGES).lower()) or word


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\n".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


class _Words:
    """The words of one text, by code points."""

    def __init__(self, body: str, starts: np.ndarray, ends: np.ndarray):
        self.body, self.starts, self.ends = body, starts.tolist(), ends.tolist()

    def mention(self, start: int, end: int, kind: int | None) -> dict:
        """The slot ``start`` to ``end`` with its patterns."""
        first = bisect_right(self.ends, start)  # the word that holds the start
        last = bisect_right(self.starts, end - 1) - 1
        lead = self.body[self.starts[first] : start].strip(_EDGES)
        left = []
        for k in range(first - 1, max(-1, first - 4), -1):
            left.append(_word(self.body[self.starts[k] : self.ends[k]]))
        left += ["^"] * (3 - len(left))
        tail = self.body[end : self.ends[last]].strip(_EDGES)
        right = tail or (self.body[self.starts[last + 1] : self.ends[last + 1]] if last + 1 < len(self.starts) else "$")
        patterns = [_hash("two", left[1], left[0]), _hash("three", left[2], left[1], left[0]), _hash("sides", left[0], _word(right))]
        if lead:
            patterns.append(_hash("label", _word(lead)))
        return {"start": start, "end": end, "instance": _hash(self.body[start:end].lower()), "kind": kind, "patterns": patterns}


def _trimmed(body: str, start: int, end: int) -> tuple[int, int]:
    token = body[start:end]
    cut = max(token.rfind("="), token.rfind(":")) + 1
    if cut and (sum(c in "0123456789" for c in token[cut:]) >= MIN_DIGITS or "@" in token[cut:]):
        start, token = start + cut, token[cut:]
    start += len(token) - len(token.lstrip(_EDGES))
    return start, start + len(token.strip(_EDGES))


def _identifiers(body: str, words: _Words, flagged: list[tuple[int, int, bool]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Slots that look like identifiers and touch no span of ``taken`` (disjoint, sorted).

    ``flagged``: (word, its digits, whether it is numeric), for words with a digit or an ``@``.
    """
    groups: list[list[int]] = []  # first word, last word, digits, numeric
    for word, digits, numeric in flagged:
        if groups and numeric and groups[-1][3] and groups[-1][1] == word - 1:
            gap = body[words.ends[word - 1] : words.starts[word]]
            if gap == " ":
                groups[-1][1], groups[-1][2] = word, groups[-1][2] + digits
                continue
        groups.append([word, word, digits, numeric])
    out, at = [], 0
    for first, last, digits, numeric in groups:
        start, end = words.starts[first], words.ends[last]
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < end:
            continue
        if digits >= MIN_DIGITS or (not numeric and "@" in body[start:end].strip(_EDGES)[1:-1]):
            start, end = _trimmed(body, start, end)
            if start < end:
                out.append((start, end))
    return out


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"
_MENTIONS = "array<struct<start:bigint,end:bigint,instance:bigint,kind:int,patterns:array<bigint>>>"


def scanned(docs: DataFrame, text: str = "text", carry: list[str] | None = None, names: tuple[str, str] = ("spans", "mentions")) -> DataFrame:
    """``carry`` columns (all by default), base spans and mentions of every text, without a shuffle."""
    carry = docs.columns if carry is None else carry
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    fields = [("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("kind", pa.int32()), ("patterns", pa.list_(pa.int64()))]

    def start():
        def work(batch: pa.RecordBatch) -> list:
            column = batch.column(text)
            spans: list[list] = [[]] * len(column)
            mentions: list[list] = [[]] * len(column)
            for texts in T.chunks(column):
                data = texts.data
                total = lambda inside: np.concatenate([[0], np.cumsum(inside)])
                digits, ats = total((data >= 48) & (data <= 57)), total(data == 64)
                marks = digits + ats
                for k in np.flatnonzero(marks[texts.bounds[1:]] > marks[texts.bounds[:-1]]).tolist():
                    low, high = int(texts.bounds[k]), int(texts.bounds[k + 1])
                    body = column[texts.first + k].as_py()
                    base = base_spans(body)
                    one = T.Texts(data[low : high + 8], np.array([0, high - low]), 0)
                    starts, ends, _ = T.words(one, T.NOT_SPACE)
                    n = digits[low + ends] - digits[low + starts]
                    flags = np.flatnonzero((n > 0) | (ats[low + ends] > ats[low + starts]))
                    place = total((one.data & 0xC0) != 0x80)
                    words = _Words(body, place[starts], place[ends])
                    numeric = total(_NUMERIC[one.data])
                    plain = numeric[ends[flags]] - numeric[starts[flags]] == ends[flags] - starts[flags]
                    flagged = list(zip(flags.tolist(), n[flags].tolist(), plain.tolist()))
                    slots = [(a, b, kind) for kind, a, b in base]
                    slots += [(a, b, None) for a, b in _identifiers(body, words, flagged, _merged(base))]
                    spans[texts.first + k] = [{"kind": kind, "start": a, "end": b} for kind, a, b in base]
                    mentions[texts.first + k] = [words.mention(*slot) for slot in slots]
            return [pa.array(spans, span), pa.array(mentions, pa.list_(pa.struct(fields)))]

        return work

    return appended(docs, carry, [(names[0], _SPANS), (names[1], _MENTIONS)], start)


def known_instances(mentions: DataFrame) -> DataFrame:
    """``(instance, kind, score)`` of instances that contexts reveal, from ``mentions (instance, kind, patterns)``."""
    edges = mentions.select("instance", F.explode("patterns").alias("pattern")).distinct()
    edges = stored(edges, "pii-edges")
    sizes = stored(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_SUPPORT), "pii-sizes")
    edges = stored(edges.join(sizes, "pattern", "left_semi"), "pii-edges")
    seeds = mentions.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    seeds = stored(seeds, "pii-seeds")
    known, before = seeds, -1
    while True:
        rated = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("weight"))
        rated = rated.join(sizes, "pattern").select("pattern", "kind", "weight", F.round(F.col("weight") / F.col("n"), 6).alias("confidence"))
        rated = rated.where((F.col("weight") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))
        rated = stored(rated.select("pattern", "kind", F.log(F.lit(1.0 + 1e-9) - F.col("confidence")).alias("doubt")), "pii-patterns")
        found = edges.join(rated, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum("doubt"))).alias("score"))
        found = found.where(F.round("score", 6) >= MIN_SCORE).join(seeds, "instance", "left_anti")
        found = stored(found.select("instance", "kind", F.least(F.lit(1.0), F.round("score", 6)).alias("score")), "pii-known")
        count = found.count()
        if count <= before:
            return found
        known, before = seeds.unionByName(found), count


def private_spans(docs: DataFrame, text: str = "text", carry: list[str] | None = None, name: str = "spans") -> DataFrame:
    """``carry`` columns (all by default) with ``name``: array<struct<kind, start, end>> by kind as listed, then start."""
    carry = docs.columns if carry is None else carry
    row, seen, more = (fresh_name([*carry, name], x) for x in ("row", "mentions", "more"))
    first = stored(scanned(docs, text, carry, (name, seen)).withColumn(row, F.monotonically_increasing_id()), "pii-scanned")
    mentions = first.select(F.col(row).alias("row"), F.inline(seen))
    known = known_instances(mentions)
    best = F.max(F.struct("score", (-F.col("kind")).alias("kind")))
    known = stored(known.groupBy("instance").agg((len(KINDS) - best["kind"]).cast("int").alias("found")), "pii-found")
    hits = mentions.where("kind is null").select("row", "start", "end", "instance").join(small_or_shuffled(known), "instance")
    hits = hits.groupBy("row").agg(F.collect_list(F.struct(F.col("found").alias("kind"), "start", "end")).alias(more))
    hits = stored(hits.withColumnRenamed("row", row), "pii-hits")
    out = first.join(small_or_shuffled(hits), row, "left")
    none = F.array().cast(_SPANS)
    return out.select(*carry, F.sort_array(F.concat(name, F.coalesce(F.col(more), none))).alias(name)).withColumn(name, _named(F.col(name)))


def _named(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, ALL_KINDS))
    return F.transform(spans, lambda s: F.struct(kinds[s["kind"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of overlapping spans the first kind names all."""
    spans, clean = (fresh_name(docs.columns, x) for x in ("spans", "clean"))

    def start():
        def work(batch: pa.RecordBatch) -> list:
            out = []
            for body, found in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist()):
                pieces, at = [], 0
                for s in sorted(found, key=lambda s: (s["start"], s["end"])):
                    if s["start"] >= at:
                        pieces += [body[at : s["start"]], f"[{s['kind']}]"]
                    at = max(at, s["end"])
                out.append(body if not found else "".join([*pieces, body[at:]]))
            return [pa.array(out, pa.string())]

        return work

    found = appended(private_spans(docs, text, name=spans), docs.columns, [(clean, "string")], start)
    return found.withColumn(text, F.col(clean)).select(*docs.columns)
