"""Gradient-boosted trees in numpy with monotonic constraints.

Trees are grown level by level on quantile bins under logistic loss and kept
as flat node arrays (feature, threshold, left, right, value), so that scoring
steps all rows down one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    base: float
    depth: int
    feature: np.ndarray  # int32, one entry per node of all trees
    threshold: np.ndarray
    left: np.ndarray  # a leaf points to itself
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                down = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(down, self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3,
        rate: float = 0.15, bins: int = 48, l2: float = 1.0, least: int = 8) -> Forest:
    """``monotone`` is per feature +1 (score never falls as it grows), -1 or 0.
    With one class, or no rows, the forest is the smoothed prior alone."""
    prior = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(prior / (1 - prior)))
    none = np.zeros(0)
    if len(y) < 2 * least or y.min() == y.max():
        return Forest(base, depth, none.astype(np.int32), none, none.astype(np.int32), none.astype(np.int32), none, none.astype(np.int32))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    width = max(len(c) for c in cuts) + 1
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node(v: float) -> int:
        n = len(value)
        for to, item in zip((feature, threshold, left, right, value), (0, 0.0, n, n, v)):
            to.append(item)
        return n

    raw = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        root = node(-g.sum() / (h.sum() + l2))
        roots.append(root)
        open_nodes = [(root, np.arange(len(y)), -np.inf, np.inf)]
        for _ in range(depth):
            following = []
            for at, rows, low, high in open_nodes:
                split = best_split(code[rows], g[rows], h[rows], width, cuts, monotone, l2, least, low, high)
                if split is None:
                    continue
                j, k, vl, vr = split
                feature[at], threshold[at] = j, cuts[j][k]
                left[at], right[at] = node(vl), node(vr)
                goes = code[rows, j] <= k
                middle = (vl + vr) / 2
                lows, highs = ((low, middle), (middle, high)), ((middle, high), (low, middle))
                (la, lb), (ra, rb) = lows if monotone[j] > 0 else highs if monotone[j] < 0 else ((low, high), (low, high))
                following += [(left[at], rows[goes], la, lb), (right[at], rows[~goes], ra, rb)]
            open_nodes = following
        for n in range(root, len(value)):
            value[n] *= rate
        one = Forest(0.0, depth, np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array([root]))
        s = one.score(x)
        raw += np.log(s / (1 - s))
    return Forest(base, depth, np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32),
                  np.array(right, np.int32), np.array(value), np.array(roots, np.int32))


def best_split(code, g, h, width, cuts, monotone, l2, least, low, high):
    """(feature, bin, left value, right value) of the largest gain that keeps
    the constraints, or None."""
    n, d = code.shape
    if n < 2 * least:
        return None
    flat = (code + np.arange(d) * width).ravel()

    def sums(v):
        return np.bincount(flat, np.repeat(v, d), d * width).reshape(d, width).cumsum(1)
    gl, hl, nl = sums(g), sums(h), sums(np.ones(n))
    gt, ht = g.sum(), h.sum()
    vl = np.clip(-gl / (hl + l2), low, high)
    vr = np.clip(-(gt - gl) / (ht - hl + l2), low, high)

    def gain(v, gs, hs):
        return -(gs * v + 0.5 * (hs + l2) * v * v)
    v0 = np.clip(-gt / (ht + l2), low, high)
    won = gain(vl, gl, hl) + gain(vr, gt - gl, ht - hl) - gain(v0, gt, ht)
    real = np.arange(width) < np.array([len(c) for c in cuts])[:, None]
    ok = real & (nl >= least) & (n - nl >= least) & (np.sign(vr - vl) * monotone[:, None] >= 0)
    won = np.where(ok, won, -np.inf)
    j, k = np.unravel_index(int(won.argmax()), won.shape)
    return (j, k, vl[j, k], vr[j, k]) if won[j, k] > 1e-6 else None
