"""Singular values and right singular vectors of a small square matrix, to high relative accuracy.

Householder reflections from both sides turn the matrix into an upper bidiagonal one. The
differential quotient-difference algorithm with shifts (dqds) finds its singular values: it works
on the squares of the entries and never subtracts but for the shift, so small values come out as
exact as large ones. Right singular vectors are eigenvectors of the tridiagonal B'B, read off a
twisted factorisation: the stationary transform from the top and the progressive one from the
bottom meet where the pivot is smallest. Vectors of values that lie very close are made
orthogonal by inverse iteration with the same factorisation.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
NEGLIGIBLE = (10 * EPS) ** 2  # of an off-diagonal square beside the value it would move
CLOSE = 1e-4  # relative gap below which vectors are made orthogonal to each other
APART = 2.0**-44  # relative step between the shifts of values in such a group, so that no vector outgrows the others
TINY = 1e-290  # stands for a pivot of zero; the largest entry is 1


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and the orthogonal P of ``matrix = Q B P'``."""
    m = np.array(matrix, float)
    n = len(m)
    p = np.eye(n)
    for k in range(n):
        v = _reflector(m[k:, k])
        if v is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < n - 2 and (v := _reflector(m[k, k + 1 :])) is not None:
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), p


def _reflector(x: np.ndarray) -> np.ndarray | None:
    most = np.abs(x).max(initial=0.0)
    if len(x) < 2 or most == 0 or not x[1:].any():
        return None
    v = x / most
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, largest first, by dqds."""
    most = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if most == 0:
        return np.zeros(len(diagonal))
    open_blocks = [([float(x) ** 2 for x in diagonal / most], [float(x) ** 2 for x in above / most], 0.0)]
    squares = []
    while open_blocks:
        q, e, moved = open_blocks.pop()
        if len(q) == 1:
            squares.append(moved + q[0])
        elif (cut := _split(q, e, moved)) is not None:
            open_blocks += [(q[: cut + 1], e[:cut], moved), (q[cut + 1 :], e[cut + 1 :], moved)]
        elif len(q) == 2:
            spread = (q[0] - q[1]) + e[0]
            large = (q[0] + q[1] + e[0] + math.sqrt(spread * spread + 4 * q[1] * e[0])) / 2
            squares += [moved + large, moved + q[0] * (q[1] / large)]
        else:
            if q[0] < q[-1]:  # large entries first: the smallest value then settles at the end
                q, e = q[::-1], e[::-1]
            open_blocks.append(_shifted(q, e, moved))
    return most * np.sqrt(np.sort(squares)[::-1])


def _split(q: list[float], e: list[float], moved: float) -> int | None:
    for i in range(len(e) - 1, -1, -1):
        if e[i] <= NEGLIGIBLE * (moved + min(q[i], q[i + 1])) or e[i] < 1e-290:
            return i
    return None


def _shifted(q: list[float], e: list[float], moved: float) -> tuple[list[float], list[float], float]:
    """One accepted sweep; a shift that is too large shows as a negative pivot and is made smaller."""
    spread = (q[-2] - q[-1]) + e[-1]
    large = (q[-2] + q[-1] + e[-1] + math.sqrt(spread * spread + 4 * q[-1] * e[-1])) / 2
    shift = q[-2] * (q[-1] / large) if large else 0.0
    for _ in range(4):
        fresh_q, fresh_e, failed_at, pivot = _sweep(q, e, shift)
        if failed_at is None:
            return fresh_q, fresh_e, moved + shift
        shift = max(0.0, shift + pivot) * (1 - 4 * EPS) if failed_at == len(q) - 1 else shift / 4
    fresh_q, fresh_e, _, _ = _sweep(q, e, 0.0)
    return fresh_q, fresh_e, moved


def _sweep(q: list[float], e: list[float], shift: float):
    d = q[0] - shift
    fresh_q, fresh_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None, None, i, d
        top = d + e[i]
        ratio = q[i + 1] / top if top > 0 else 0.0
        fresh_q.append(top)
        fresh_e.append(e[i] * ratio)
        d = (d * ratio if top > 0 else q[i + 1]) - shift
    if d < 0:
        return None, None, len(q) - 1, d
    return [*fresh_q, d], fresh_e, None, d


class _Twisted:
    """Twisted factorisation of B'B less a shift."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, shift: float):
        n = len(diagonal)

        def pivot(x):
            return x if abs(x) > TINY else math.copysign(TINY, x)

        squares = [max(float(x) ** 2, TINY) for x in diagonal]
        low = [float(b) / math.copysign(math.sqrt(s), a) for a, b, s in zip(diagonal, above, squares)]
        s, self.down, down_pivots = -shift, [], []
        top = [s]
        for i in range(n - 1):
            down_pivots.append(pivot(s + squares[i]))
            self.down.append(squares[i] * low[i] / down_pivots[i])
            s = self.down[i] * low[i] * s - shift
            top.append(s)
        p, self.up, up_pivots, bottom = squares[-1] - shift, [0.0] * (n - 1), [0.0] * n, [0.0] * n
        bottom[-1] = p
        for i in range(n - 2, -1, -1):
            up_pivots[i + 1] = pivot(squares[i] * low[i] ** 2 + p)
            ratio = squares[i] / up_pivots[i + 1]
            self.up[i] = low[i] * ratio
            p = p * ratio - shift
            bottom[i] = p
        meet = [a + b + shift for a, b in zip(top, bottom)]
        self.at = int(np.argmin(np.abs(meet)))
        self.pivots = [*down_pivots[: self.at], pivot(meet[self.at]), *up_pivots[self.at + 1 :]]

    def spread(self, y: np.ndarray) -> np.ndarray:
        """Solve N'x = y outwards from the twist."""
        x = y.copy()
        for i in range(self.at - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(self.at, len(x) - 1):
            x[i + 1] -= self.up[i] * x[i]
        x /= np.abs(x).max()
        return x / np.linalg.norm(x)

    def vector(self) -> np.ndarray:
        y = np.zeros(len(self.pivots))
        y[self.at] = 1.0
        return self.spread(y)

    def solve(self, right: np.ndarray) -> np.ndarray:
        y = right.copy()
        for i in range(self.at - 1):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 2, self.at, -1):
            y[i] -= self.up[i] * y[i + 1]
        if self.at > 0:
            y[self.at] -= self.down[self.at - 1] * y[self.at - 1]
        if self.at < len(y) - 1:
            y[self.at] -= self.up[self.at] * y[self.at + 1]
        y /= np.array(self.pivots)
        return self.spread(y / np.abs(y).max())


def bidiagonal_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors, one column per value; values come largest first."""
    n = len(diagonal)
    most = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0)) or 1.0
    diagonal, above, values = diagonal / most, above / most, values / most
    found, group = np.zeros((n, len(values))), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            group = k
        twisted = _Twisted(diagonal, above, float(value) ** 2 * (1 + APART * (k - group)))
        if group == k:
            found[:, k] = twisted.vector()
            continue
        others, z = found[:, group:k], np.random.default_rng(k).normal(size=n)
        for _ in range(4):
            z = _beside(others, twisted.solve(_beside(others, z)))
        found[:, k] = z
    return found


def _beside(others: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The unit vector left of z without its parts along the others."""
    for _ in range(2):
        z = z - others @ (others.T @ z)
    return z / np.linalg.norm(z)


def right_vectors(matrix: np.ndarray, count: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All singular values, largest first, and the right singular vectors of the first ``count``."""
    if not len(matrix):
        return np.zeros(0), np.zeros((0, 0))
    diagonal, above, p = bidiagonalise(matrix)
    values = singular_values(diagonal, above)
    return values, p @ bidiagonal_vectors(diagonal, above, values[:count])
