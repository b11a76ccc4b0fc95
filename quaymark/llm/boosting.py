"""Gradient-boosted trees for a yes-or-no target, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 48


@dataclass
class Trees:
    """Full trees of one depth: per tree and inner node a feature and threshold, per leaf a value."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < inner:  # all nodes are at the same depth
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 2.0) -> Trees:
    """Newton boosting of the logistic loss; of equal gains the first feature and lowest threshold are taken."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    p = float((weight * y).sum() / weight.sum())
    start = float(np.log((p + 1e-6) / (1 - p + 1e-6)))
    z = np.full(n, start)
    inner = 2**depth - 1
    features, thresholds, values = [], [], []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-z))
        g, h = weight * (y - q), weight * q * (1 - q) + 1e-9
        node = np.zeros(n, dtype=np.int64)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            gain, pick = np.zeros(count), [(0, np.inf)] * count
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                slot = at * BINS + binned[:, j]
                gs = np.bincount(slot, g, count * BINS).reshape(count, BINS)
                hs = np.bincount(slot, h, count * BINS).reshape(count, BINS)
                gl, hl = gs.cumsum(1)[:, : len(c)], hs.cumsum(1)[:, : len(c)]
                ga, ha = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                won = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                k = won.argmax(1)
                best = won[np.arange(count), k]
                for i in np.flatnonzero(best > gain + 1e-9):
                    gain[i], pick[i] = best[i], (j, c[k[i]])
            for i, (j, t) in enumerate(pick):
                feature[first + i], threshold[first + i] = j, t
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        z += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(start, np.array(features), np.array(thresholds), np.array(values))
