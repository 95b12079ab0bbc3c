"""Small gradient-boosted trees and isotonic calibration over a bounded sample.

Fitted in memory on the sample its caller bounds (thousands of rows, tens of
features); prediction is vectorised and runs inside the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    feature: np.ndarray
    threshold: np.ndarray  # go right where x > threshold
    value: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.threshold[at])
        return self.value[at - (2**self.depth - 1)]


@dataclass
class BoostedTrees:
    start: float
    rate: float
    trees: list[Tree] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += self.rate * t.predict(x)
        return out


def _grow(x: np.ndarray, cuts: list[np.ndarray], binned: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float) -> Tree:
    n_inner = 2**depth - 1
    feature, threshold = np.zeros(n_inner, dtype=np.int64), np.full(n_inner, np.inf)
    at = np.zeros(len(x), dtype=np.int64)
    for node in range(n_inner):
        mine = np.flatnonzero(at == node)
        best = (1e-9, 0, np.inf)
        if len(mine):
            gm, hm = g[mine], h[mine]
            gs, hs = gm.sum(), hm.sum()
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(binned[mine, f], gm, len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[mine, f], hm, len(c) + 1))[:-1]
                gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                gain[(hl < least) | (hs - hl < least)] = -1
                b = int(np.argmax(gain))
                if gain[b] > best[0]:
                    best = (gain[b], f, c[b])
        _, feature[node], threshold[node] = best
        at[mine] = 2 * node + 1 + (x[mine, feature[node]] > threshold[node])
    leaf = at - n_inner
    value = -np.bincount(leaf, g, n_inner + 1) / (np.bincount(leaf, h, n_inner + 1) + ridge)
    return Tree(feature, threshold, value, depth)


def fit_boosting(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 1.0
) -> BoostedTrees:
    """Logistic loss, second-order leaves, quantile-binned splits."""
    p = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = BoostedTrees(float(np.log(p / (1 - p))), rate)
    if not len(y) or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    cuts = [c[c < col.max()] for c, col in zip(cuts, x.T, strict=True)]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], axis=1)
    margin = np.full(len(y), model.start)
    for _ in range(trees):
        q = 1 / (1 + np.exp(-margin))
        t = _grow(x, cuts, binned, q - y, q * (1 - q), depth, ridge, least)
        model.trees.append(t)
        margin += rate * t.predict(x)
    return model


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit (pool adjacent violators)."""
    if not len(score):
        return np.array([0.0]), np.array([0.5])
    at, inverse = np.unique(score, return_inverse=True)
    weight = np.bincount(inverse).astype(float)
    mean = np.bincount(inverse, y) / weight
    blocks: list[list[float]] = []  # mean, weight, first, last
    for i, (m, w) in enumerate(zip(mean, weight, strict=True)):
        blocks.append([m, w, i, i])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _, last = blocks.pop()
            b = blocks[-1]
            b[0] = (b[0] * b[1] + m2 * w2) / (b[1] + w2)
            b[1] += w2
            b[3] = last
    xs = np.array([at[int(b[k])] for b in blocks for k in (2, 3)])
    ys = np.array([b[0] for b in blocks for _ in (2, 3)])
    keep = np.concatenate(([True], (np.diff(xs) > 0) | (np.diff(ys) > 0)))
    return xs[keep], ys[keep]


def apply_isotonic(knots: tuple[np.ndarray, np.ndarray], score: np.ndarray) -> np.ndarray:
    return np.interp(score, *knots)
