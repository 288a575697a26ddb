"""Gradient-boosted trees of depth two for small training tables, and their
form as a SQL expression."""

from __future__ import annotations

import numpy as np


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 25, rate: float = 0.4, least: float = 5.0) -> list[tuple]:
    """Trees for the logistic loss: (feature, cut, left, right) where a side is
    (feature, cut, value if below, value otherwise)."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 25))) for j in range(m)]
    f, trees = np.zeros(n), []

    def leaf(g, h) -> float:
        return float(rate * g.sum() / (h.sum() + 1.0))

    def split(rows, g, h) -> tuple[int, float] | None:
        best, found = 1e-9, None
        total_g, total_h = g[rows].sum(), h[rows].sum()
        base = total_g**2 / (total_h + 1)
        for j in range(m):
            below = x[rows, j][:, None] < cuts[j][None, :]
            gl, hl, nl = g[rows] @ below, h[rows] @ below, below.sum(0)
            gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - base
            gain[(nl < least) | (len(rows) - nl < least)] = -1
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > best:
                best, found = float(gain[k]), (j, float(cuts[j][k]))
        return found

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        root = split(np.arange(n), g, h)
        if root is None:
            break
        sides = []
        for rows in (np.flatnonzero(x[:, root[0]] < root[1]), np.flatnonzero(x[:, root[0]] >= root[1])):
            inner = split(rows, g, h) or root
            low = x[rows, inner[0]] < inner[1]
            a, b = leaf(g[rows[low]], h[rows[low]]), leaf(g[rows[~low]], h[rows[~low]])
            f[rows] += np.where(low, a, b)
            sides.append((*inner, a, b))
        trees.append((*root, *sides))
    return trees


def margin(x: np.ndarray, trees: list[tuple]) -> np.ndarray:
    out = np.zeros(len(x))
    for j, cut, left, right in trees:
        a = np.where(x[:, left[0]] < left[1], left[2], left[3])
        b = np.where(x[:, right[0]] < right[1], right[2], right[3])
        out += np.where(x[:, j] < cut, a, b)
    return out


def as_sql(trees: list[tuple], names: list[str]) -> str:
    side = lambda s: f"if({names[s[0]]} < {s[1]!r}D, {s[2]!r}D, {s[3]!r}D)"
    return " + ".join(f"if({names[j]} < {cut!r}D, {side(a)}, {side(b)})" for j, cut, a, b in trees) or "0.0D"
