"""Gradient-boosted regression trees with logistic loss, in numpy."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of fixed depth over features cut into at most ``bins`` quantile bins."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.base = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        mean = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
        self.base = float(np.log(mean / (1 - mean)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)], 1)
        score = np.full(len(y), self.base)
        self.trees = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, cuts, y - p, p * (1 - p))
            self.trees.append(tree)
            score += tree[2][leaf]
        return self

    def _grow(self, binned: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray):
        inner = 2**self.depth - 1
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(grad), np.int64)  # node of each row, numbered as in a heap
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = (1e-9, 0, -1)
            if len(rows) > 1:
                g, h = grad[rows], hess[rows]
                whole = g.sum() ** 2 / (h.sum() + self.ridge)
                for f in range(binned.shape[1]):
                    if not len(cuts[f]):
                        continue
                    b = binned[rows, f]
                    gl = np.cumsum(np.bincount(b, g, len(cuts[f]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h, len(cuts[f]) + 1))[:-1]
                    gain = gl**2 / (hl + self.ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + self.ridge) - whole
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
            if best[2] >= 0:
                feature[node], threshold[node] = best[1], cuts[best[1]][best[2]]
                right = binned[rows, best[1]] > best[2]
            else:
                right = np.zeros(len(rows), bool)
            at[rows] = 2 * node + 1 + right
        leaf = at - inner
        value = np.bincount(leaf, grad, 2**self.depth) / (np.bincount(leaf, hess, 2**self.depth) + self.ridge)
        return (feature, threshold, self.rate * value), leaf

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            score += value[at - (2**self.depth - 1)]
        return score
