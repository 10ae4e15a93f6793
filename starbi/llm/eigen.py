"""Leading eigenpairs of a small symmetric matrix, on the driver.

The matrix is at most as wide as an embedding, so this is bounded by the schema
and not by the rows.  Householder reflections make it tridiagonal; the number of
negative pivots of T - x (a Sturm count) tells how many eigenvalues lie below x,
and bisection on it encloses each wanted eigenvalue by itself; inverse iteration
on T gives its vector, made orthogonal to those of the same cluster of close
eigenvalues in every step; the reflections carry the vectors back.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: eigenvalues nearer than this share of the norm are one cluster
CLUSTER = 1e-3
#: steps of inverse iteration; one is mostly enough, ties take a second
STEPS = 4


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections."""
    a = np.array(matrix, float)
    n = len(a)
    off, mirrors = np.zeros(max(n - 1, 0)), []
    for k in range(n - 1):
        column = a[k + 1:, k].copy()
        length = np.linalg.norm(column)
        if k == n - 2 or np.linalg.norm(column[1:]) == 0:
            off[k] = column[0]
            mirrors.append(np.zeros(n - k - 1))
            continue
        off[k] = -np.copysign(length, column[0])
        column[0] -= off[k]
        v = column / np.linalg.norm(column)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        mirrors.append(v)
    return np.diag(a).copy(), off, mirrors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are smaller than each of ``at``."""
    least = max(np.finfo(float).tiny, np.max(off ** 2, initial=0) * np.finfo(float).tiny * 4)
    pivot = diagonal[0] - at
    below = np.zeros(len(at), int)
    for i in range(len(diagonal)):
        if i:
            pivot = diagonal[i] - at - off[i - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low = np.full(count, np.min(diagonal - reach))
    high = np.full(count, np.max(diagonal + reach))
    width = max(np.max(np.abs(low)), np.max(np.abs(high)))
    low, high = low - EPS * width * n, high + EPS * width * n
    wanted = n - 1 - np.arange(count)  # places in rising order
    while True:
        middle = (low + high) / 2
        done = (middle <= low) | (middle >= high) | (high - low <= EPS * EPS * width)
        if done.all():
            return high
        above = count_below(diagonal, off, middle) <= wanted
        low = np.where(above & ~done, middle, low)
        high = np.where(~above & ~done, middle, high)


class _Shifted:
    """T - x factored with row exchanges, to solve for many right sides."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, at: float, least: float) -> None:
        n = len(diagonal)
        self.up, self.up1, self.up2 = np.zeros(n), np.zeros(n), np.zeros(n)
        self.times, self.swapped = np.zeros(n), np.zeros(n, bool)
        row = [diagonal[0] - at, off[0] if n > 1 else 0.0, 0.0]
        for i in range(n - 1):
            following = [off[i], diagonal[i + 1] - at, off[i + 1] if i + 2 < n else 0.0]
            if abs(following[0]) > abs(row[0]):
                row, following, self.swapped[i] = following, row, True
            if abs(row[0]) < least:
                row[0] = least
            self.up[i], self.up1[i], self.up2[i] = row
            self.times[i] = t = following[0] / row[0]
            row = [following[1] - t * row[1], following[2] - t * row[2], 0.0]
        self.up[n - 1] = row[0] if abs(row[0]) >= least else least

    def solve(self, right: np.ndarray) -> np.ndarray:
        y, n = right.copy(), len(right)
        for i in range(n - 1):
            if self.swapped[i]:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= self.times[i] * y[i]
        for i in reversed(range(n)):
            if i + 1 < n:
                y[i] -= self.up1[i] * y[i + 1]
            if i + 2 < n:
                y[i] -= self.up2[i] * y[i + 2]
            y[i] /= self.up[i]
        return y


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, one column per value."""
    n = len(diagonal)
    norm = max(np.max(np.abs(diagonal)), np.max(np.abs(off), initial=0)) or 1.0
    out = np.zeros((n, len(values)))
    first, shift = 0, np.inf  # of the running cluster
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        shift = min(value, shift - 10 * EPS * norm) if k > first else value
        solver = _Shifted(diagonal, off, shift, EPS * norm)
        y = np.random.default_rng(k).standard_normal(n)
        for _ in range(STEPS):
            near = out[:, first:k]
            for _ in range(2):
                y = y - near @ (near.T @ y)
            y = solver.solve(y / np.linalg.norm(y))
        for _ in range(2):
            y = y - near @ (near.T @ y)
        out[:, k] = y / np.linalg.norm(y)
    return out


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as
    columns (the largest entry of each is positive)."""
    scale = np.max(np.abs(matrix), initial=0)
    count = min(count, len(matrix))
    if scale == 0 or count == 0:
        return np.zeros(count), np.eye(len(matrix))[:, :count]
    diagonal, off, mirrors = tridiagonal(np.asarray(matrix, float) / scale)
    values = leading_values(diagonal, off, count)
    vectors = leading_vectors(diagonal, off, values)
    for k in reversed(range(len(mirrors))):
        v = mirrors[k]
        vectors[k + 1:] -= 2 * np.outer(v, v @ vectors[k + 1:])
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(count)])
    return values * scale, vectors * signs
