"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, bisection by Sturm counts, inverse iteration.

The matrix has one row per dimension of the vectors, whatever their number, so this is work of the driver.
"""

from __future__ import annotations

import numpy as np

#: Eigenvalues closer than this share of the norm count as one cluster, whose vectors are kept orthogonal to each other.
CLUSTER = 1e-3
SWEEPS = 5


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and the unit Householder vectors (one per row, zero where nothing was to be reflected)."""
    a = np.array(matrix, float)
    size = len(a)
    reflectors = np.zeros((max(size - 2, 0), size))
    for k in range(size - 2):
        x = a[k + 1 :, k]
        scale = np.abs(x[1:]).max()
        if scale == 0:
            continue
        v = x / max(scale, abs(x[0]))
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        reflectors[k, k + 1 :] = v
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        x -= 2 * (v @ x) * v
        a[k, k + 1 :] = x
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each value: negative pivots of T - value."""
    least = np.finfo(float).tiny * max(1.0, float(np.max(off**2, initial=0)))
    pivot = diagonal[0] - at
    count = (pivot < 0).astype(int)
    for d, e in zip(diagonal[1:], off, strict=True):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - at - e * e / pivot
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The `count` largest eigenvalues, falling, bisected until no double lies between the bounds."""
    radius = np.concatenate([[0], np.abs(off)]) + np.concatenate([np.abs(off), [0]])
    low, high = float((diagonal - radius).min()), float((diagonal + radius).max())
    slack = 1e-12 * max(abs(low), abs(high)) + np.finfo(float).tiny
    wanted = len(diagonal) - 1 - np.arange(count)
    lows, highs = np.full(count, low - slack), np.full(count, high + slack)
    while True:
        middle = lows + (highs - lows) / 2
        open_ = (middle > lows) & (middle < highs)
        if not open_.any():
            return middle
        above = count_below(diagonal, off, middle) <= wanted
        lows, highs = np.where(open_ & above, middle, lows), np.where(open_ & ~above, middle, highs)


def _solve(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - value) x = right by elimination with row exchanges; a vanishing pivot counts as `least`."""
    size = len(diagonal)
    d, up, up2, x = diagonal - value, np.append(off, 0.0), np.zeros(size), right.copy()
    for i in range(size - 1):
        below = off[i]
        if abs(below) > abs(d[i]):
            factor = d[i] / below
            d[i], up[i], d[i + 1], up2[i] = below, d[i + 1], up[i] - factor * d[i + 1], up[i + 1]
            up[i + 1] = -factor * up2[i]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            d[i] = d[i] if abs(d[i]) >= least else np.copysign(least, d[i])
            factor = below / d[i]
            d[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    d[-1] = d[-1] if abs(d[-1]) >= least else np.copysign(least, d[-1])
    for i in range(size - 1, -1, -1):
        x[i] = (x[i] - (up[i] * x[i + 1] if i + 1 < size else 0) - (up2[i] * x[i + 2] if i + 2 < size else 0)) / d[i]
        if abs(x[i]) > 1e200:
            x /= 1e200
    return x


def leading_pairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues, falling, and their unit eigenvectors as columns. Of each vector the entry largest
    in size is positive."""
    size = len(matrix)
    count = min(count, size)
    scale = float(np.abs(matrix).max(initial=0))
    if scale == 0:
        return np.zeros(count), np.eye(size)[:, :count]
    diagonal, off, reflectors = tridiagonal(np.asarray(matrix, float) / scale)
    values = leading_values(diagonal, off, count)
    norm = float(max(np.abs(diagonal).max(), np.abs(off).max(initial=0)))
    least = np.finfo(float).eps * norm
    random = np.random.default_rng(12)
    vectors = np.zeros((size, count))
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        near = vectors[:, first:k]
        x = random.uniform(-1, 1, size)
        for _ in range(SWEEPS):
            x = _solve(diagonal, off, value, x / np.abs(x).max(), least)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= near @ (near.T @ x)
            x /= np.linalg.norm(x)
        vectors[:, k] = x
    for k in range(len(reflectors) - 1, -1, -1):
        vectors -= 2 * np.outer(reflectors[k], reflectors[k] @ vectors)
    vectors /= np.linalg.norm(vectors, axis=0)
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(count)]
    return values * scale, vectors * np.where(top < 0, -1.0, 1.0)
