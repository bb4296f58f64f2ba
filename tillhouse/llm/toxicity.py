"""Toxicity: a logistic classifier over words and word beginnings, regularised by counterfactual identity swaps.

Labelled texts that name a group ("women", "Muslims", ...) are repeated with the terms swapped for others of the same
kind. The fit adds ``swap_weight`` times the mean squared difference between the logits of a text and its twin to the
logistic loss, so that naming a group does not move a score, whatever the labels suggest.

Features are the distinct words of a text (A-Z as a-z; runs of letters, digits and non-ASCII characters) and the first
3 to 8 bytes of longer words, each a 64-bit hash. The labelled rows are a bounded sample (``MAX_LABELLED``, the smallest
hashes of doc_id); their features are counted in Spark, the ``MAX_FEATURES`` most telling ones by chi-square are kept,
and only their positions reach the driver, which fits a few thousand weights. Scoring is one narrow pass over all texts.

A document with contradicting labels counts as toxic. Labels without id, verdict or document are unused. Without labels
every score is the prior, close to zero. Null and empty texts have the score of a text without features. Rows are scored
one by one, so repeated rows come out repeated; very long texts are scored whole. An empty table gives no rows. Extra
columns are carried along if asked for; the new column gets a name that none of them has.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm import text as T
from tillhouse.llm.decontaminate import WORD
from tillhouse.llm.frames import appended, fresh_name, smallest, stored

MAX_LABELLED = 20_000
MAX_FEATURES = 4096
MIN_ROWS = 4
THRESHOLD = 0.3
PREFIXES = (3, 4, 5, 6, 7, 8)
_BITS = 21

#: Terms that are swapped within their line. A parameter of ``train``; one word each, lower case.
IDENTITY_TERMS = [
    "women men girls boys woman man girl boy".split(),
    "muslim christian jewish hindu buddhist atheist".split(),
    "muslims christians jews hindus buddhists atheists".split(),
    "black white asian latino arab african european".split(),
    "gay straight lesbian bisexual transgender queer".split(),
    "immigrants refugees foreigners natives citizens".split(),
    "disabled blind deaf autistic".split(),
    "frauen männer mädchen jungen".split(),
    "muslime christen juden ausländer flüchtlinge".split(),
    "femmes hommes filles garçons".split(),
    "musulmans chrétiens juifs étrangers réfugiés".split(),
    "mujeres hombres niñas niños".split(),
    "musulmanes cristianos judíos extranjeros refugiados".split(),
]


def held_out(doc: Column) -> Column:
    """True for the rows no label is learnt from."""
    return F.coalesce(F.crc32(doc.cast("string")) % 4 == 2, F.lit(False))


def features(texts: T.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Parallel arrays: text number and feature, with repeats."""
    lowered = T.Texts(T.LOWER[texts.data], texts.bounds, texts.first)
    starts, ends, first = T.words(lowered, WORD)
    of, length = T.owner(first), ends - starts
    view = T.lanes(lowered.data)
    rows, found = [of], [T.word_hashes(lowered.data, starts, ends, seed=1)]
    for k in PREFIXES:
        some = np.flatnonzero(length > k)
        mask = np.uint64((1 << (8 * k)) - 1)
        rows.append(of[some])
        found.append(T.mixed((view[starts[some]] & mask) + np.uint64(k)))
    return np.concatenate(rows), np.concatenate(found)


def _distinct(rows: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
    return rows[new], found[new]


class Swap:
    """Replaces identity terms by the next one of their line; None for a text without any."""

    def __init__(self, terms: list[list[str]]):
        self.next = {t: line[(i + 1) % len(line)] for line in terms for i, t in enumerate(line) if len(line) > 1}
        listed = "|".join(sorted(map(re.escape, self.next), key=len, reverse=True))
        self.find = re.compile(rf"(?<!\w)({listed})(?!\w)", re.I) if listed else None

    def __call__(self, text: str) -> str | None:
        if self.find is None or not self.find.search(text):
            return None
        return self.find.sub(lambda m: self.next[m[0].lower()] if m[0].lower() in self.next else m[0], text)


def sampled(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """At most ``limit`` labelled documents outside the held-out quarter: doc_id, text, toxic."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = smallest(stored(known, "toxic-labels"), F.xxhash64("doc_id"), limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``limit`` narrow rows
    return stored(rows.dropDuplicates(["doc_id"]), "toxic-sample")


class Model:
    """Sorted feature hashes with weights, and a bias."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: float):
        self.known, self.weights, self.bias = known, weights, bias
        self.bitmap = np.zeros(1 << _BITS, dtype=bool)
        self.bitmap[known & np.uint64((1 << _BITS) - 1)] = True

    def positions(self, texts: T.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Parallel arrays: text number and position of each known feature it has."""
        rows, found = features(texts)
        maybe = np.flatnonzero(self.bitmap[found & np.uint64((1 << _BITS) - 1)])
        rows, found = rows[maybe], found[maybe]
        at = np.searchsorted(self.known, found)
        at[at == len(self.known)] = 0
        good = self.known[at] == found if len(self.known) else np.zeros(len(at), dtype=bool)
        return _distinct(rows[good], at[good])

    def scores(self, texts: T.Texts) -> np.ndarray:
        rows, at = self.positions(texts)
        logit = self.bias + np.bincount(rows, weights=self.weights[at], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _telling(sample: DataFrame, total: int, toxic: int, limit: int) -> np.ndarray:
    """The features whose presence tells most about the label, by chi-square."""

    def count(batches):
        for batch in batches:
            label = np.array(batch.column("toxic").to_pylist(), dtype=np.int64)
            for texts in T.chunks(batch.column("text"), 8 * T.CHUNK_BYTES):
                rows, found = _distinct(*features(texts))
                known, at = np.unique(found, return_inverse=True)
                n = np.bincount(at, minlength=len(known))
                t = np.bincount(at, weights=label[texts.first + rows] > 0, minlength=len(known))
                arrays = [pa.array(known.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(t.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, names=["feature", "n", "t"])

    counts = sample.mapInArrow(count, "feature bigint, n bigint, t bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    expect = F.col("n") * F.lit(toxic / max(total, 1))
    chi = (F.col("t") - expect) * (F.col("t") - expect) / (expect * (1 - F.lit(toxic / max(total, 1))) * (1 - F.col("n") / F.lit(total + 1)))
    best = counts.where(F.col("n") >= MIN_ROWS).orderBy(chi.desc(), "feature").limit(limit)
    return np.array([r["feature"] for r in best.select("feature").collect()], dtype=np.int64).view(np.uint64)


def train(docs: DataFrame, labels: DataFrame, swap_weight: float = 1.0, terms=IDENTITY_TERMS, limit: int = MAX_LABELLED, l2: float = 3e-4) -> Model:
    """Fits on at most ``limit`` labelled rows outside the held-out quarter."""
    sample = sampled(docs, labels, limit)
    seen = sample.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("t")).first()
    total, toxic = seen["n"], seen["t"] or 0
    prior = (toxic + 0.01) / (total + 1)
    bias = float(np.log(prior / (1 - prior)))
    if not 0 < toxic < total:
        return Model(np.zeros(0, np.uint64), np.zeros(0), bias)
    named = pa.array([t for line in terms for t in line])
    own = np.concatenate([features(texts)[1] for texts in T.chunks(named)]) if len(named) else np.zeros(0, np.uint64)
    known = np.unique(np.concatenate([_telling(sample, total, toxic, MAX_FEATURES), own]))
    base = sample.sparkSession.sparkContext.broadcast(Model(known, np.zeros(len(known)), 0.0))

    def positions(batches):
        model, swap = base.value, Swap(terms)

        def listed(column):
            out = []
            for texts in T.chunks(column):
                rows, at = model.positions(texts)
                edge = np.searchsorted(rows, np.arange(len(texts) + 1))
                out += [at[a:b].astype(np.int32) for a, b in zip(edge, edge[1:])]
            return out

        for batch in batches:
            plain = [x.as_py() or "" for x in batch.column("text")]
            twins = [swap(x) for x in plain]
            same, other = listed(pa.array(plain, pa.string())), listed(pa.array([t or "" for t in twins], pa.string()))
            other = [o if t is not None else None for o, t in zip(other, twins)]
            kind = pa.list_(pa.int32())
            arrays = [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), pa.array(same, kind), pa.array(other, kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "toxic", "same", "other"])

    rows = sample.mapInArrow(positions, "doc_id bigint, toxic int, same array<int>, other array<int>").collect()
    rows.sort(key=lambda r: r["doc_id"])
    pairs = [(k, r["other"]) for k, r in enumerate(rows) if r["other"] is not None]
    y = np.array([r["toxic"] > 0 for r in rows], dtype=float)
    weights, bias = fit([r["same"] for r in rows], y, pairs, len(known), bias, swap_weight, l2)
    return Model(known, weights, bias)


def fit(same, y, pairs, width: int, bias: float, swap_weight: float, l2: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Full-batch Adam on logistic loss + l2 + swap_weight * mean((logit - twin's logit)^2)."""

    def flat(lists):
        return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.array([i for x in lists for i in x], dtype=np.int64)

    rows, at = flat(same)
    base = np.array([k for k, _ in pairs], dtype=np.int64)
    twin_rows, twin_at = flat([x for _, x in pairs])
    w = np.zeros(width + 1)
    w[-1] = bias
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        logit = w[-1] + np.bincount(rows, weights=w[at], minlength=len(y))
        slope = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y) / len(y)
        grad = np.zeros_like(w)
        grad[-1] = slope.sum()
        if len(base):
            gap = logit[base] - w[-1] - np.bincount(twin_rows, weights=w[twin_at], minlength=len(base))
            pull = 2 * swap_weight * gap / len(base)
            slope[base] += pull  # the bias is the same on both sides, so its gradient stays
            grad[:-1] -= np.bincount(twin_at, weights=pull[twin_rows], minlength=width)
        grad[:-1] += np.bincount(at, weights=slope[rows], minlength=width) + l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def scored(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None, name: str = "score") -> DataFrame:
    """``carry`` columns (all by default) with a score from 0 to 1 in column ``name``."""
    carry = docs.columns if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value
        return lambda batch: [pa.array(np.concatenate([own.scores(texts) for texts in T.chunks(batch.column(text))]))]

    return appended(docs, carry, [(name, "double")], start)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    score = fresh_name(docs.columns, "score")
    return scored(docs, train(docs, labels), name=score).where(F.col(score) < threshold).drop(score)
