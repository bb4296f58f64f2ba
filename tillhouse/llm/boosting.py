"""Gradient-boosted trees on binned features, small enough to be fitted on a driver and applied in tasks.

Trees are complete binary trees of a fixed depth, kept as arrays: feature and bin of every inner node, value of every
leaf. A split is chosen by the usual second-order gain of the logistic loss; a node without a useful split passes all
rows to the left.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    def __init__(self, edges: list[np.ndarray], base: float, rate: float):
        self.edges, self.base, self.rate = edges, base, rate
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def binned(self, x: np.ndarray, features=None) -> np.ndarray:
        """Bins of these features, one column each (of all by default)."""
        features = range(len(self.edges)) if features is None else features
        out = np.empty((len(x), len(features)), dtype=np.uint8)
        for place, k in enumerate(features):
            out[:, place] = np.searchsorted(self.edges[k], x[:, k], side="right")
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        used = np.unique(np.concatenate([feature for feature, _, _ in self.trees])) if self.trees else np.zeros(0, dtype=np.int64)
        bins = self.binned(x, used)
        out = np.full(len(bins), self.base)
        rows = np.arange(len(bins))
        for feature, cut, value in self.trees:
            feature = np.searchsorted(used, feature)
            at = np.zeros(len(bins), dtype=np.int64)
            for _ in range(int(np.log2(len(value)))):
                at = 2 * at + 1 + (bins[rows, feature[at]] > cut[at])
            out += self.rate * value[at - len(feature)]
        return out


def _edges(column: np.ndarray) -> np.ndarray:
    """Cuts between bins: quantiles, and for a column of few values one between any two."""
    values = np.unique(column)
    if len(values) <= BINS:
        return values[1:].astype(np.float64)
    return np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]))


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2, l2: float = 1.0) -> Boosted:
    """Fits on the rows of ``x`` with labels ``y`` in 0..1; deterministic."""
    edges = [_edges(c) for c in x.T]
    mean = float(np.clip((y * weight).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    model = Boosted(edges, float(np.log(mean / (1 - mean))), rate)
    if not len(y):
        return model
    bins = model.binned(x)
    telling = [k for k in range(x.shape[1]) if bins[:, k].min() < bins[:, k].max()]  # a constant tells nothing
    logit = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = weight * (p - y), weight * p * (1 - p)
        inner, leaves = 2**depth - 1, 2**depth
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, 255, dtype=np.int64)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            node = at - first
            best = np.full(n, 1e-6)
            for k in telling:
                cell = node * (BINS + 1) + bins[:, k]
                gs = np.bincount(cell, weights=g, minlength=n * (BINS + 1)).reshape(n, -1).cumsum(1)
                hs = np.bincount(cell, weights=h, minlength=n * (BINS + 1)).reshape(n, -1).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                top = gain.argmax(1)
                value = gain[np.arange(n), top]
                better = value > best
                best[better] = value[better]
                feature[first : first + n][better], cut[first : first + n][better] = k, top[better]
            at = 2 * at + 1 + (bins[np.arange(len(y)), feature[at]] > cut[at])
        leaf = at - inner
        value = -np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + l2)
        model.trees.append((feature, cut, value))
        logit += rate * value[leaf]
    return model
