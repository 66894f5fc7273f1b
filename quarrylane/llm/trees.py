"""Small gradient-boosted trees for binary labels, fitted with numpy on bounded samples."""

from __future__ import annotations

import numpy as np

#: A node is (feature, cut, left, right) or a leaf's value; x goes left if x[feature] <= cut.
Node = tuple | float


def _grow(bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, least: float) -> Node:
    g, h = grad[rows].sum(), hess[rows].sum()
    value = float(g / (h + 1.0))
    if depth == 0 or len(rows) < 2:
        return value
    best = (1e-6, -1, -1)
    for f, c in enumerate(cuts):
        if not len(c):
            continue
        b = bins[rows, f]
        gs = np.bincount(b, grad[rows], len(c) + 1).cumsum()[:-1]
        hs = np.bincount(b, hess[rows], len(c) + 1).cumsum()[:-1]
        gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
        gain[(hs < least) | (h - hs < least)] = -1
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k)
    _, f, k = best
    if f < 0:
        return value
    left = bins[rows, f] <= k
    grow = lambda part: _grow(bins, cuts, grad, hess, part, depth - 1, least)
    return (f, float(cuts[f][k]), grow(rows[left]), grow(rows[~left]))


def predict(node: Node, x: np.ndarray) -> np.ndarray:
    if not isinstance(node, tuple):
        return np.full(len(x), node)
    f, cut, left, right = node
    out, goes = np.empty(len(x)), x[:, f] <= cut
    out[goes], out[~goes] = predict(left, x[goes]), predict(right, x[~goes])
    return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, share: float = 0.7, bins: int = 64, least: float = 2.0, seed: int = 7) -> tuple[float, list[Node]]:
    """(start, trees): the log-odds of y = 1 are start + rate times the sum of the trees' values.

    Each tree sees a random share of the rows. Split points are quantiles of each feature.
    """
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    cuts = [np.unique(np.concatenate([c, (c[1:] + c[:-1]) / 2])) if len(c) else c for c in cuts]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start, found = float(np.log(mean / (1 - mean))), []
    odds = np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        rows = np.flatnonzero(rng.random(len(y)) < share)
        node = _grow(binned, cuts, y - p, p * (1 - p), rows, depth, least)
        found.append(node)
        odds += rate * predict(node, x)
    return start, found


def paths(node: Node, so_far: tuple = ()) -> list[tuple]:
    """The conditions (feature, goes left, cut) from the root to each node below it."""
    if not isinstance(node, tuple):
        return []
    f, cut, left, right = node
    ways = [(so_far + ((f, True, cut),), left), (so_far + ((f, False, cut),), right)]
    return [way for way, _ in ways] + [p for way, below in ways for p in paths(below, way)]
