"""Gradient-boosted trees for small tables of features, fitted and evaluated with numpy.

Logistic loss, histograms of at most 32 quantile bins, trees of fixed depth grown level by level.
Meant for bounded training samples on the driver; a fitted model is a few kilobytes.
"""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 32, smooth: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.smooth = rounds, depth, rate, bins, smooth
        self.base, self.trees, self.edges = 0.0, [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x, y = np.asarray(x, float), np.asarray(y, float)
        p = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        self.base = float(np.log(p / (1 - p)))
        self.trees = []
        if len(y) == 0 or y.min() == y.max():
            return self
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], 1)
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-score))
            grad, hess = y - prob, prob * (1 - prob)
            node = np.zeros(len(y), np.int64)
            splits = []
            for level in range(self.depth):
                level_splits = np.zeros((2**level, 2), np.int64) - 1
                for k in range(2**level):
                    m = node == k
                    if m.sum() < 8:
                        continue
                    g, h, best = grad[m], hess[m], (1e-6, -1, 0)
                    whole = g.sum() ** 2 / (h.sum() + self.smooth)
                    for j in range(code.shape[1]):
                        n = len(self.edges[j]) + 1
                        if n < 2:
                            continue
                        gl = np.cumsum(np.bincount(code[m, j], g, n))[:-1]
                        hl = np.cumsum(np.bincount(code[m, j], h, n))[:-1]
                        gain = gl**2 / (hl + self.smooth) + (g.sum() - gl) ** 2 / (h.sum() - hl + self.smooth) - whole
                        i = int(gain.argmax())
                        if gain[i] > best[0]:
                            best = (gain[i], j, i)
                    level_splits[k] = best[1:]
                feature, cut = level_splits[node, 0], level_splits[node, 1]
                right = (feature >= 0) & (code[np.arange(len(y)), np.maximum(feature, 0)] > cut)
                node = node * 2 + right
                splits.append(level_splits)
            leaves = 2**self.depth
            value = self.rate * np.bincount(node, grad, leaves) / (np.bincount(node, hess, leaves) + self.smooth)
            score += value[node]
            self.trees.append((splits, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row."""
        x = np.asarray(x, float)
        if not self.trees or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], 1)
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for splits, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for s in splits:
                feature, cut = s[node, 0], s[node, 1]
                node = node * 2 + ((feature >= 0) & (code[rows, np.maximum(feature, 0)] > cut))
            score += value[node]
        return 1 / (1 + np.exp(-score))
