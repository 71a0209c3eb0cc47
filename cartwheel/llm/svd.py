"""Singular values and right singular vectors of a small matrix: Householder
bidiagonalisation, dqds, and twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``r = U B V^T``, B upper bidiagonal."""
    a, d = np.array(r, float), r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if not norm or not np.any(x[1:]):
            return None
        w = x / norm
        w[0] += np.copysign(1.0, w[0])
        return w / np.linalg.norm(w)
    for k in range(d):
        w = reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        w = reflector(a[k, k + 1:]) if k + 2 < d else None
        if w is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, each to
    high relative accuracy: differential quotient differences with shifts that
    are taken back where they go beyond the least value left."""
    found: list[float] = []

    def step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
        n, d, low = len(q), q[0] - shift, q[0] - shift
        out_q, out_e = [0.0] * n, [0.0] * (n - 1)
        for i in range(n - 1):
            out_q[i] = d + e[i]
            t = q[i + 1] / out_q[i] if out_q[i] > 0 else (0.0 if not q[i + 1] else np.inf)
            out_e[i] = e[i] * t
            d = d * t - shift
            low = min(low, d)
            if not d >= 0:  # also not a number
                return None if shift else (out_q, out_e, 0.0)
        out_q[-1] = d
        return (out_q, out_e, low) if low >= 0 else None

    def solve(q: list[float], e: list[float], done: float) -> None:
        guess = 0.0
        while q:
            n = len(q)
            small = [i for i in range(n - 1) if e[i] <= EPS * EPS * (done + q[i]) or e[i] <= EPS * EPS * min(q[i], q[i + 1]) or e[i] < TINY]
            if n == 1:
                found.append(done + q[0])
                return
            if small:  # falls apart
                k = small[-1] + 1
                solve(q[k:], e[k:], done)
                q, e, guess = q[:k], e[:k - 1], 0.0
                continue
            # the least value of the last two rows is above the least of all, and near it in the end
            a, b, c = q[-2] + e[-1], np.sqrt(q[-1]) * np.sqrt(e[-1]), q[-1]
            trailing = c - b * b / ((a - c) / 2 + np.copysign(np.hypot((a - c) / 2, b), a - c)) if b else min(a, c)
            shift = max(0.0, min(trailing, guess) if guess else trailing) * (1 - 1e-9)
            got = step(q, e, shift)
            while got is None:
                shift = shift / 2 if shift > EPS * (done + q[-1]) else 0.0
                got = step(q, e, shift)
            q, e, guess = got
            done += shift
    # scaled: squares of very small entries would vanish
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if not scale:
        return np.zeros(len(diagonal))
    solve([float(x) ** 2 for x in diagonal / scale], [float(x) ** 2 for x in above / scale], 0.0)
    return np.sort(np.array(found))[::-1] * scale ** 2


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """(unit eigenvector of B^T B for the eigenvalue near ``value``, the value
    bettered by the Rayleigh quotient)."""
    n, scale = len(diagonal), max(np.abs(diagonal).max(), TINY)
    a = np.where(np.abs(diagonal) < EPS * EPS * scale, EPS * EPS * scale, diagonal)
    d, low = a * a, above / a[:-1]  # B^T B = L D L^T

    def safe(x: float) -> float:
        return x if x else EPS * EPS * scale * scale
    for _ in range(3):
        s, lower = np.empty(n), np.empty(n - 1)  # from the top: stationary
        s[0] = -value
        for i in range(n - 1):
            pivot = safe(d[i] + s[i])
            lower[i] = d[i] * low[i] / pivot
            s[i + 1] = lower[i] * low[i] * s[i] - value
        p, upper = np.empty(n), np.empty(n - 1)  # from the bottom: progressive
        p[-1] = d[-1] - value
        for i in range(n - 2, -1, -1):
            t = d[i] / safe(d[i] * low[i] * low[i] + p[i + 1])
            upper[i] = low[i] * t
            p[i] = p[i + 1] * t - value
        gamma = s + p + value
        k = int(np.argmin(np.abs(gamma)))  # where the factorisations meet
        z = np.zeros(n)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -upper[i] * z[i]
        square = float(z @ z)
        better = value + gamma[k] / square
        if abs(better - value) <= 4 * EPS * abs(value):
            break
        value = better
    return z / np.sqrt(square), value


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values above rounding, falling, at most ``most``;
    their unit right singular vectors as columns)."""
    diagonal, above, v = bidiagonal(r)
    values = dqds(diagonal, above)
    rank = int((values > (len(values) * EPS) ** 2 * values[:1].max(initial=0.0) * len(values)).sum())
    values = values[:min(most, rank)]
    vectors = np.empty((len(diagonal), len(values)))
    for k, value in enumerate(values):
        z = twisted(diagonal, above, float(value))[0] if len(diagonal) > 1 else np.ones(1)
        # values too near for vectors of their own: any orthogonal basis of their space
        near = [j for j in range(k) if values[j] - value <= 1e-6 * values[j]]
        for j in [*near, *near]:
            z = z - (vectors[:, j] @ z) * vectors[:, j]
        if near and np.linalg.norm(z) < 1e-3:
            z = rest_of(vectors[:, :k], diagonal, above, float(value))
        vectors[:, k] = z / np.linalg.norm(z)
    return values, v @ vectors


def rest_of(known: np.ndarray, diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """A vector for a value of which all vectors found point into ``known``:
    inverse iteration from a start outside of it."""
    n = len(diagonal)
    b = np.diag(diagonal) + np.diag(above, 1)
    # off the value by more than rounding, so that it can be solved, and by far less than to the next one
    shifted = b.T @ b - (value + 1e-12 * max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0)) ** 2) * np.eye(n)
    z = np.random.default_rng(n + known.shape[1]).standard_normal(n)
    for _ in range(4):
        z -= known @ (known.T @ z)
        z = np.linalg.solve(shifted, z / np.linalg.norm(z))
        z -= known @ (known.T @ z)
    return z
