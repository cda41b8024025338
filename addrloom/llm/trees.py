"""Bagged decision trees over a bounded labelled sample: trained with numpy on the driver, applied to Arrow batches anywhere."""

from __future__ import annotations

import numpy as np

BINS = 64


class BaggedTrees:
    """`count` trees of at most `depth` levels, each grown on rows drawn with replacement; deterministic for a given order of rows.

    A feature is cut at quantiles of the different values in the sample. Without rows of both labels every score is the share of positive rows (0 if none)."""

    def __init__(self, count: int = 25, depth: int = 6, seed: int = 7):
        self.count, self.depth, self.seed = count, depth, seed
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BaggedTrees:
        self.base = float(y.mean()) if len(y) else 0.0
        self.trees = []
        if not len(y) or self.base in (0.0, 1.0):
            return self
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(np.unique(c), quantiles)) for c in x.T]
        self.cuts = [np.unique(np.concatenate((c, [(v.min() + v.max()) / 2]))) for c, v in zip(self.cuts, x.T)]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)], axis=1)
        rng = np.random.default_rng(self.seed)
        for _ in range(self.count):
            weight = np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y)).astype(float)
            self.trees.append(self._grow(binned, y.astype(float), weight))
        return self

    def _grow(self, binned: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes in heap order: (feature or -1 for a leaf, cut, share of positive rows)."""
        size = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        at = np.zeros(len(y), np.int64)
        width = max(len(c) for c in self.cuts) + 1
        for node in range(size):
            rows = np.flatnonzero((at == node) & (weight > 0))
            if not len(rows):
                continue
            w, wy = weight[rows], weight[rows] * y[rows]
            n, pos = w.sum(), wy.sum()
            value[node] = pos / n
            if 2 * node + 2 >= size or pos in (0.0, n):
                continue
            best = (1e-9, -1, -1)
            for f, cuts in enumerate(self.cuts):
                b = binned[rows, f]
                left, left_pos = np.cumsum(np.bincount(b, w, width))[: len(cuts)], np.cumsum(np.bincount(b, wy, width))[: len(cuts)]
                right, right_pos = n - left, pos - left_pos
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where((left > 0) & (right > 0), left_pos**2 / left + right_pos**2 / right - pos**2 / n, 0.0)
                if len(gain) and gain.max() > best[0]:
                    ties = np.flatnonzero(gain >= gain.max() - 1e-12)
                    best = (gain.max(), f, int(ties[len(ties) // 2]))  # the middle of the gap between the two sides
            if best[1] < 0:
                continue
            feature[node], cut[node] = best[1], self.cuts[best[1]][best[2]]
            at[rows] = np.where(binned[rows, best[1]] <= best[2], 2 * node + 1, 2 * node + 2)
        return feature, cut, value

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of positive rows over the trees, for each row of `x`."""
        if not self.trees:
            return np.full(len(x), self.base)
        out = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                at = np.where(f < 0, at, 2 * at + 1 + (x[every, np.maximum(f, 0)] > cut[at]))
            out += value[at]
        return out / len(self.trees)
