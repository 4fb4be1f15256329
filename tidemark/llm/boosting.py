"""Gradient-boosted trees of one depth for a binary target, as array operations."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Trees as arrays: node i has the children 2i+1 (value <= cut) and 2i+2."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    prior: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for rows x (n, k)."""
        out, rows = np.full(len(x), self.prior), np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                own = f[node]
                go = 2 * node + 1 + (x[rows, np.maximum(own, 0)] > c[node])
                node = np.where(own >= 0, go, node)
            out += v[node]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, shrink: float = 1.0) -> Boosted:
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(k)], 1)
    share = (y.sum() + 0.5) / (n + 1)
    prior = float(np.log(share / (1 - share)))
    raw = np.full(n, prior)
    nodes = (1 << (depth + 1)) - 1
    feature, cut, leaf = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth + 1):
            for i in range((1 << level) - 1, (1 << (level + 1)) - 1):
                own = np.flatnonzero(node == i)
                if not len(own):
                    continue
                all_g, all_h = g[own].sum(), h[own].sum()
                leaf[t, i] = rate * all_g / (all_h + shrink)
                if level == depth:
                    continue
                best, where = 1e-6, None
                for j in range(k):
                    if not len(edges[j]):
                        continue
                    gl = np.cumsum(np.bincount(binned[own, j], g[own], len(edges[j]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[own, j], h[own], len(edges[j]) + 1))[:-1]
                    gain = gl**2 / (hl + shrink) + (all_g - gl) ** 2 / (all_h - hl + shrink) - all_g**2 / (all_h + shrink)
                    b = int(np.argmax(gain))
                    if gain[b] > best:
                        best, where = gain[b], (j, b)
                if where:
                    j, b = where
                    feature[t, i], cut[t, i] = j, edges[j][b]
                    node[own] = 2 * i + 1 + (binned[own, j] > b)
        raw += leaf[t][node]
    return Boosted(feature, cut, leaf, prior, depth)
