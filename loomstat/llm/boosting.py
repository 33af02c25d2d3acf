"""Gradient-boosted trees for two classes: logistic loss, Newton leaf values, splits over quantile bins."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS, RIDGE, LEAST = 50, 5, 0.2, 32, 1.0, 2.0


@dataclass
class Boosted:
    """Complete trees: node k has the children 2k + 1 and 2k + 2; a row goes right where its feature is above the cut."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at - inner]
        return out


def fit(x: np.ndarray, label: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Boosted:
    """Every tree is grown level by level on the gradient of the loss of those before it."""
    n, width = x.shape
    if not n:
        return Boosted(np.zeros((0, 1), np.int64), np.zeros((0, 1), np.float32), np.zeros((0, 2)), 0.0)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])  # bin > b means x > edges[b]
    share = np.clip(np.average(label, weights=weight), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    feature, cut = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32)
    value, score = np.zeros((trees, inner + 1)), np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, curvature = weight * (p - label), weight * p * (1 - p)
        at = np.zeros(n, np.int64)
        for d in range(depth):
            first, count = 2**d - 1, 2**d
            key = (at - first) * BINS
            best = np.zeros(count)
            for f in range(width):
                if not len(edges[f]):
                    continue
                g = np.bincount(key + binned[f], gradient, count * BINS).reshape(count, BINS)
                h = np.bincount(key + binned[f], curvature, count * BINS).reshape(count, BINS)
                gl, hl = np.cumsum(g, axis=1)[:, : len(edges[f])], np.cumsum(h, axis=1)[:, : len(edges[f])]
                gt, ht = g.sum(axis=1)[:, None], h.sum(axis=1)[:, None]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hl < LEAST) | (ht - hl < LEAST)] = 0
                k = gain.argmax(axis=1)
                gain = gain[np.arange(count), k]
                better = gain > best + 1e-9
                best[better] = gain[better]
                feature[t, first : first + count][better] = f
                cut[t, first : first + count][better] = edges[f][k[better]]
            at = 2 * at + 1 + (x[np.arange(n), feature[t][at]] > cut[t][at])
        leaf = at - inner
        value[t] = -RATE * np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, curvature, inner + 1) + RIDGE)
        score += value[t][leaf]
    return Boosted(feature, cut, value, base)
