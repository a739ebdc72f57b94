"""Gradient-boosted trees for two classes, in numpy, flattened into node arrays; some features may be monotonic."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Nodes of all trees side by side: a row per tree. A leaf points to itself, so all rows descend alike."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1; a row goes left if its feature is at most the threshold."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                go_left = x[rows, self.feature[t][node]] <= self.threshold[t][node]
                node = np.where(go_left, self.left[t][node], self.right[t][node])
            out += self.value[t][node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, monotonic: dict[int, int] | None = None, trees: int = 60, depth: int = 3,
        rate: float = 0.2, bins: int = 64, ridge: float = 2.0, least: float = 5.0, weights: np.ndarray | None = None,
        offset: np.ndarray | None = None) -> Trees:
    """Logistic loss, second order, thresholds at quantiles. ``monotonic[f]`` is 1 or -1 if the score may only rise or fall
    with feature f: a split in the wrong order is not taken, and both sides stay on their side of the split's middle in
    all later splits. A row of weight n counts as n rows. Without rows of both classes the trees are empty and the
    score is constant. With an ``offset``, log odds known of each row, trees add to that, and one class will do.
    """
    monotonic = monotonic or {}
    times = np.ones(len(y)) if weights is None else weights
    share = ((times * y).sum() + 0.5) / (times.sum() + 1.0)
    base = float(np.log(share / (1 - share))) if offset is None else 0.0
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)
            for f in range(x.shape[1])]
    coded = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]
    size = 2 ** (depth + 1) - 1
    parts: list[tuple] = []
    margin = np.full(len(y), base) if offset is None else offset.astype(float)
    able = 0 < y.sum() < len(y) if offset is None else len(y) > 0
    for _ in range(trees if able else 0):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = times * (y - p), np.maximum(times * p * (1 - p), 1e-9)
        feature, threshold = np.zeros(size, np.int64), np.full(size, np.inf)
        left, right, value = np.arange(size), np.arange(size), np.zeros(size)
        node_of, bounds = np.zeros(len(y), np.int64), {0: (-np.inf, np.inf)}
        for node in range(size):
            if node not in bounds:
                continue
            own = np.flatnonzero(node_of == node)
            low, high = bounds[node]
            g, h = gradient[own].sum(), weight[own].sum()
            value[node] = np.clip(g / (h + ridge), low, high) * rate
            if 2 * node + 2 >= size:
                continue
            best = (1e-6, None)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(coded[f][own], gradient[own], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(coded[f][own], weight[own], len(c) + 1))[:-1]
                gr, hr = g - gl, h - hl
                wl, wr = np.clip(gl / (hl + ridge), low, high), np.clip(gr / (hr + ridge), low, high)
                gain = gl * gl / (hl + ridge) + gr * gr / (hr + ridge) - g * g / (h + ridge)
                allowed = (hl >= least) & (hr >= least) & ((wr - wl) * monotonic.get(f, 0) >= 0)
                gain = np.where(allowed, gain, -1.0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, float(wl[k]), float(wr[k])))
            if best[1] is None:
                continue
            f, k, wl, wr = best[1]
            feature[node], threshold[node] = f, cuts[f][k]
            left[node], right[node] = 2 * node + 1, 2 * node + 2
            node_of[own] = np.where(coded[f][own] <= k, left[node], right[node])
            middle, way = (wl + wr) / 2, monotonic.get(f, 0)
            bounds[2 * node + 1] = (low, min(high, middle)) if way > 0 else (max(low, middle), high) if way < 0 else (low, high)
            bounds[2 * node + 2] = (max(low, middle), high) if way > 0 else (low, min(high, middle)) if way < 0 else (low, high)
        margin = margin + value[node_of]
        parts.append((feature, threshold, left, right, value))
    if not parts:
        parts = [(np.zeros(size, np.int64), np.full(size, np.inf), np.arange(size), np.arange(size), np.zeros(size))]
    return Trees(base, *(np.stack(a) for a in zip(*parts)), depth)
