"""Small gradient-boosted trees for span decisions: logistic loss, histogram splits, a calibrated threshold."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Boosted regression trees of fixed depth over quantile-binned features."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 24, smoothing: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.smoothing = trees, depth, rate, bins, smoothing
        self.model: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base, self.slope, self.shift, self.threshold = 0.0, 1.0, 0.0, 0.5

    def fit(self, x: np.ndarray, y: np.ndarray, held: np.ndarray) -> "Boosted":
        """Train on the rows that aren't ``held``; calibrate the probability and the threshold on those that are."""
        train, labels = x[~held], y[~held].astype(float)
        edges = [np.unique(np.quantile(train[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, train[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        rate = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        margin = np.full(len(labels), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = labels - p, p * (1 - p)
            feature = np.zeros(2**self.depth - 1, dtype=np.int64)
            cut = np.full(2**self.depth - 1, np.inf)
            node = np.zeros(len(labels), dtype=np.int64)
            for level in range(self.depth):
                first = 2**level - 1
                best = np.full(2**level, 1e-9)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    width = len(e) + 1
                    slot = (node - first) * width + binned[:, f]
                    gs = np.bincount(slot, g, 2**level * width).reshape(-1, width).cumsum(axis=1)
                    hs = np.bincount(slot, h, 2**level * width).reshape(-1, width).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.smoothing) + (gt - gs) ** 2 / (ht - hs + self.smoothing) - gt**2 / (ht + self.smoothing)
                    at = gain[:, :-1].argmax(axis=1)
                    value = gain[np.arange(len(at)), at]
                    for k in np.flatnonzero(value > best):
                        best[k], feature[first + k], cut[first + k] = value[k], f, e[at[k]]
                node = 2 * node + 1 + (train[np.arange(len(node)), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + self.smoothing) * self.rate
            self.model.append((feature, cut, value))
            margin += value[leaf]
        self._calibrate(self.margins(x[held]), y[held].astype(float))
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.model:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out

    def _calibrate(self, margin: np.ndarray, y: np.ndarray) -> None:
        """Logistic calibration by Newton steps, then the threshold of the best F1."""
        a, b = 1.0, 0.0
        for _ in range(25):
            p = 1 / (1 + np.exp(-(a * margin + b)))
            g = np.array([((y - p) * margin).sum() - 0.01 * (a - 1), (y - p).sum() - 0.01 * b])
            w = p * (1 - p)
            hess = np.array([[(w * margin**2).sum() + 0.01, (w * margin).sum()], [(w * margin).sum(), w.sum() + 0.01]])
            step = np.linalg.solve(hess, g)
            a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
        self.slope, self.shift = a, b
        p = self._squash(margin)
        marks = np.linspace(0.05, 0.95, 37)
        scores = [2 * (y * (p >= t)).sum() / max(1.0, y.sum() + (p >= t).sum()) for t in marks]
        good = [t for t, s in zip(marks, scores) if s >= max(scores) - 1e-9]
        self.threshold = float(good[len(good) // 2])

    def _squash(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self._squash(self.margins(x))
