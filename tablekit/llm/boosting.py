"""Gradient boosted trees for two classes in numpy: Newton steps on binned features, and calibration of their scores."""

from __future__ import annotations

import numpy as np

DEPTH = 3
BINS = 32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Boosted:
    """Complete trees of ``DEPTH`` splits: ``feature`` and ``bound`` of each inner node, ``value`` of each leaf."""

    def __init__(self) -> None:
        self.start = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, bound, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            out += value[at - (2**DEPTH - 1)]
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, rate: float = 0.2, ridge: float = 1.0) -> Boosted:
        """Boost the weighted log loss; splits lie between quantiles of each feature."""
        share = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        self.start, self.trees = float(np.log(share / (1 - share))), []
        bounds = [_bounds(x[:, f]) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(b, x[:, f], side="left") for f, b in enumerate(bounds)], 1)
        raw = np.full(len(x), self.start)
        for _ in range(rounds):
            odds = sigmoid(raw)
            slope, curve = weight * (odds - y), weight * odds * (1 - odds)
            tree = self._grow(binned, bounds, slope, curve, rate, ridge)
            self.trees.append(tree)
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[np.arange(len(x)), tree[0][at]] > tree[1][at])
            raw += tree[2][at - (2**DEPTH - 1)]
        return self

    def _grow(self, binned, bounds, slope, curve, rate, ridge) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = 2**DEPTH - 1
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(binned), np.int64)
        for level in range(DEPTH):
            first = 2**level - 1
            for node in range(first, 2 * first + 1):
                own = np.flatnonzero(at == node)
                best = 1e-9
                for f, cuts in enumerate(bounds):
                    if not len(cuts) or len(own) < 2:
                        continue
                    g = np.cumsum(np.bincount(binned[own, f], slope[own], len(cuts) + 1))
                    h = np.cumsum(np.bincount(binned[own, f], curve[own], len(cuts) + 1))
                    gain = g[:-1] ** 2 / (h[:-1] + ridge) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge) - g[-1] ** 2 / (h[-1] + ridge)
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, feature[node], bound[node] = gain[k], f, cuts[k]
            beyond = np.array([len(bounds[f]) if b == np.inf else np.searchsorted(bounds[f], b) for f, b in zip(feature, bound)])
            at = 2 * at + 1 + (binned[np.arange(len(binned)), feature[at]] > beyond[at])
        leaf = at - inner
        value = -rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, curve, inner + 1) + ridge)
        return feature, bound, value


def _bounds(values: np.ndarray) -> np.ndarray:
    """At most ``BINS`` - 1 bounds between distinct values of a feature."""
    distinct = np.unique(values)
    if len(distinct) > BINS:
        distinct = np.unique(np.quantile(values, np.linspace(0, 1, BINS)))
    return (distinct[:-1] + distinct[1:]) / 2


class Calibration:
    """Isotonic regression of labels on scores (pool adjacent violators), read as steps between the pools' scores."""

    def __init__(self, raw: np.ndarray, y: np.ndarray) -> None:
        order = np.argsort(raw, kind="stable")
        sums, sizes, ends = [], [], []
        for score, target in zip(raw[order].tolist(), y[order].tolist()):
            if ends and ends[-1] == score:
                sums[-1] += target
                sizes[-1] += 1
            else:
                sums.append(target)
                sizes.append(1)
                ends.append(score)
            while len(sums) > 1 and sums[-2] * sizes[-1] >= sums[-1] * sizes[-2]:
                total, size, end = sums.pop(), sizes.pop(), ends.pop()
                sums[-1], sizes[-1], ends[-1] = sums[-1] + total, sizes[-1] + size, end
        self.ends = np.array(ends)
        self.values = np.array(sums) / np.maximum(np.array(sizes), 1) if sums else np.zeros(0)

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.ends):
            return np.zeros(len(raw))
        return self.values[np.minimum(np.searchsorted(self.ends, raw, side="left"), len(self.ends) - 1)]


def threshold(probability: np.ndarray, y: np.ndarray, precision: float, least: int) -> float:
    """The smallest probability from which on ``precision`` of the held examples are right; infinite if fewer than ``least`` are."""
    best = np.inf
    for p in np.unique(probability)[::-1]:
        chosen = probability >= p
        if y[chosen].sum() >= least and y[chosen].mean() >= precision:
            best = float(p)
    return best
