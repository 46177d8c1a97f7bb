"""Gradient-boosted regression trees for a yes-no target, on binned features."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BINS = 32


class Tree(NamedTuple):
    """Nodes in order of creation; a leaf has feature -1, others go left where the feature is
    at most ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            feature = self.feature[at]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return self.value[at]
            node = at[inner]
            smaller = x[inner, feature[inner]] <= self.cut[node]
            at[inner] = np.where(smaller, self.left[node], self.right[node])


class Forest(NamedTuple):
    start: float
    trees: list[Tree]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += tree(x)
        return out


def boost(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 40,
    depth: int = 5,
    rate: float = 0.2,
    least: float = 1.0,
    ridge: float = 1.0,
) -> Forest:
    """Trees that follow the gradient of the log loss, each with Newton steps in its leaves."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)], axis=1)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    logits, grown = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logits))
        tree = _grow(binned, cuts, y - p, p * (1 - p), depth, rate, least, ridge)
        logits += tree(x)
        grown.append(tree)
    return Forest(start, grown)


def _grow(binned, cuts, gradient, weight, depth, rate, least, ridge) -> Tree:
    feature, cut, left, right, value = [], [], [], [], []

    def add(rows: np.ndarray, level: int) -> int:
        node = len(feature)
        g, h = gradient[rows].sum(), weight[rows].sum()
        for column, default in ((feature, -1), (cut, 0.0), (left, 0), (right, 0)):
            column.append(default)
        value.append(rate * g / (h + ridge))
        best, chosen = 1e-6, None
        if level < depth:
            for f in range(binned.shape[1]):
                n = len(cuts[f]) + 1
                gs = np.cumsum(np.bincount(binned[rows, f], gradient[rows], n))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, f], weight[rows], n))[:-1]
                gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
                gain[(hs < least) | (h - hs < least)] = 0
                if len(gain) and gain.max() > best:
                    best, chosen = float(gain.max()), (f, int(gain.argmax()))
        if chosen:
            f, b = chosen
            smaller = binned[rows, f] <= b
            feature[node], cut[node] = f, float(cuts[f][b])
            left[node] = add(rows[smaller], level + 1)
            right[node] = add(rows[~smaller], level + 1)
        return node

    add(np.arange(len(gradient)), 0)
    return Tree(*(np.array(c) for c in (feature, cut, left, right, value)))
