"""Histogram gradient-boosted trees in numpy, for binary labels.

Features are cut into at most BINS quantile bins. Trees grow level by level
from per-node histograms of the gradients of the logistic loss. A fitted model
is a few arrays: every tree is complete, node k having children 2k + 1 and
2k + 2, so scoring is ``depth`` rounds of indexing for all rows and trees at
once. Fitting takes a bounded sample and runs on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``threshold`` of the inner nodes and ``value`` of the
    leaves, a row per tree; ``base`` is the log-odds before any tree."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        trees, inner = self.feature.shape
        depth = inner.bit_length()
        row = np.arange(len(x))
        for t in range(trees):
            node = np.zeros(len(x), dtype=np.int64)
            feature, threshold = self.feature[t], self.threshold[t]
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            out += self.value[t][node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
        l2: float = 1.0, least: float = 5.0) -> Trees:
    """Trees for labels ``y`` (0/1). ``least`` is the smallest hessian sum of
    a leaf. With no rows, or one class, the model is a constant."""
    n, width = x.shape
    inner = (1 << depth) - 1
    rate_of_one = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate_of_one / (1 - rate_of_one)))
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    f_x = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-f_x))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            wide = 1 << level
            first = wide - 1
            at = node - first
            best = np.full(wide, 1e-9)
            for f in range(width):
                size = len(cuts[f]) + 1
                if size == 1:
                    continue
                cell = at * size + binned[f]
                g = np.bincount(cell, grad, wide * size).reshape(wide, size).cumsum(1)
                h = np.bincount(cell, hess, wide * size).reshape(wide, size).cumsum(1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
                gain[(hl < least) | (ht - hl < least)] = 0
                top = gain.argmax(1)
                won = gain[np.arange(wide), top]
                for k in np.flatnonzero(won > best):
                    best[k] = won[k]
                    feature[t, first + k], threshold[t, first + k] = f, cuts[f][top[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        value[t] = rate * g / (h + l2)
        f_x += value[t][leaf]
    return Trees(base, feature, threshold, value)
