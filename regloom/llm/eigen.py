"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation,
Sturm-count bisection, inverse iteration with reorthogonalisation in clusters.

The matrix is as wide as an embedding, whatever the number of rows, and is
solved on the driver."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues nearer than this share of the norm are one cluster.
CLUSTER = 1e-3
ROUNDS = 6


def tridiagonal(matrix: np.ndarray):
    """(diagonal, off-diagonal, reflectors): unit vectors v of I - 2 v v', each
    acting on the rows below its number."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    off, reflectors = np.zeros(max(n - 1, 0)), []
    for k in range(n - 1):
        v = a[k + 1:, k].copy()
        size = float(np.linalg.norm(v))
        off[k] = -np.copysign(size, v[0])
        v[0] -= off[k]
        length = float(np.linalg.norm(v))
        if length == 0.0 or k == n - 2:  # nothing to turn, or nothing below: the last entry stands as it is
            if k == n - 2:
                off[k] = a[k + 1, k]
            reflectors.append(None)
            continue
        v /= length
        inner = a[k + 1:, k + 1:]
        w = inner @ v
        w -= (v @ w) * v
        inner -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        reflectors.append(v)
    return a.diagonal().copy(), off, reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eigenvalues less than each value of ``at``: negative pivots of T - at."""
    least = np.finfo(np.float64).tiny * max(1.0, float(np.max(off * off, initial=0.0)))
    count = np.zeros(len(at), dtype=np.int64)
    pivot = np.ones(len(at))
    for i, d in enumerate(diagonal):
        pivot = d - at - (off[i - 1] * off[i - 1] / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, to the last bit that bisection tells apart."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    pad = EPS * n * float(np.max(np.abs(diagonal) + reach, initial=0.0))
    low = np.full(k, float(np.min(diagonal - reach)) - pad)
    high = np.full(k, float(np.max(diagonal + reach)) + pad)
    rank = n - np.arange(1, k + 1)  # eigenvalues that are smaller
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        above = count_below(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, least: float):
    """Solver of (T - shift) x = b by elimination with row exchanges."""
    n = len(diagonal)
    upper = np.zeros((n, 3))
    lower, swapped = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0), dtype=bool)
    row = [diagonal[0] - shift, off[0] if n > 1 else 0.0, 0.0]
    for i in range(n - 1):
        below = [off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0]
        if abs(below[0]) > abs(row[0]):
            row, below, swapped[i] = below, row, True
        if abs(row[0]) < least:
            row[0] = least
        upper[i] = row
        lower[i] = factor = below[0] / row[0]
        row = [below[1] - factor * row[1], below[2] - factor * row[2], 0.0]
    upper[n - 1] = [row[0] if abs(row[0]) >= least else least, 0.0, 0.0]

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= lower[i] * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= upper[i, 1] * x[i + 1]
            if i + 2 < n:
                x[i] -= upper[i, 2] * x[i + 2]
            x[i] /= upper[i, 0]
            if abs(x[i]) > 1e150:  # only the direction counts
                x /= abs(x[i])
        return x
    return solve


def leading_pairs(matrix: np.ndarray, k: int):
    """(values, vectors): the ``k`` largest eigenvalues, falling, and unit
    eigenvectors as columns. A vector's largest entry is positive."""
    n = len(matrix)
    k = min(k, n)
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_values(diagonal, off, k)
    norm = float(np.max(np.abs(diagonal), initial=0.0) + 2 * np.max(np.abs(off), initial=0.0)) or 1.0
    found: list[np.ndarray] = []
    for j in range(k):
        mates = [i for i in range(j) if values[i] - values[j] <= CLUSTER * norm]
        twins = sum(values[i] - values[j] <= 10 * EPS * norm for i in mates)
        solve = _solver(diagonal, off, values[j] - twins * 4 * EPS * norm, EPS * norm)
        x = np.random.default_rng(j + 1).standard_normal(n)
        for _ in range(ROUNDS):
            x = solve(x / np.linalg.norm(x))
            x /= np.max(np.abs(x))
            for _ in range(2):
                for i in mates:
                    x -= (found[i] @ x) * found[i]
        found.append(x / np.linalg.norm(x))
    vectors = np.array(found).T.reshape(n, k)
    for step in range(len(reflectors) - 1, -1, -1):
        v = reflectors[step]
        if v is not None:
            vectors[step + 1:] -= 2.0 * np.outer(v, v @ vectors[step + 1:])
    vectors /= np.linalg.norm(vectors, axis=0)
    top = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(k)]
    return values, vectors * np.where(top < 0, -1.0, 1.0)
