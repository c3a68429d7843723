"""Small gradient-boosted trees for binary labels, fitted on a bounded table with numpy."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic boosting of depth-limited trees over quantile split points, then Platt scaling.

    Trees are kept as flat arrays, so predicting is a few vectorised steps per tree.
    """

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 16, least: int = 8):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.trees, self.base, self.scale = [], 0.0, (1.0, 0.0)

    def fit(self, x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> "Boosted":
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            tree = self._grow(x, y - q, q * (1 - q) + 1e-6, cuts)
            self.trees.append(tree)
            score += self._apply(tree, x)
        self._calibrate(self.raw(held_x), held_y)
        return self

    def _grow(self, x, grad, hess, cuts):
        feature, cut, left, value = [], [], [], []

        def node(rows, depth):
            me = len(feature)
            g, h = grad[rows].sum(), hess[rows].sum()
            feature.append(-1), cut.append(0.0), left.append((0, 0)), value.append(self.rate * g / (h + 1.0))
            if depth == 0 or len(rows) < 2 * self.least:
                return me
            best = (1e-6, None, None)
            for j, points in enumerate(cuts):
                column = x[rows, j]
                for c in points:
                    low = column <= c
                    n = int(low.sum())
                    if n < self.least or len(rows) - n < self.least:
                        continue
                    gl, hl = grad[rows][low].sum(), hess[rows][low].sum()
                    gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                    if gain > best[0]:
                        best = (gain, j, c)
            if best[1] is not None:
                low = x[rows, best[1]] <= best[2]
                feature[me], cut[me] = best[1], float(best[2])
                left[me] = (node(rows[low], depth - 1), node(rows[~low], depth - 1))
            return me

        node(np.arange(len(grad)), self.depth)
        return np.array(feature), np.array(cut), np.array(left), np.array(value)

    def _apply(self, tree, x):
        feature, cut, children, value = tree
        at = np.zeros(len(x), dtype=int)
        for _ in range(self.depth):
            f = feature[at]
            go = f >= 0
            right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[at]
            at = np.where(go, children[at, right.astype(int)], at)
        return value[at]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((self._apply(t, x) for t in self.trees), np.zeros(len(x)))

    def _calibrate(self, raw, y, steps: int = 400):
        a, b = 1.0, 0.0
        for _ in range(steps):
            q = 1 / (1 + np.exp(-(a * raw + b)))
            a -= 0.1 * float(((q - y) * raw).mean()) / (float((raw * raw).mean()) + 1e-9)
            b -= 0.1 * float((q - y).mean())
        self.scale = (a, b)

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-(a * self.raw(x) + b)))
