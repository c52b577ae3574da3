"""Singular values and right singular vectors of a small square matrix by way of a bidiagonal one.

Householder reflections make the matrix upper bidiagonal, the differential quotient-difference algorithm with shifts
(dqds) finds the squared singular values, and twisted factorisations give their vectors. All of it works on one matrix
of the vectors' width, never on rows of a table.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
# An off-diagonal square this small beside its neighbours is zero.
NEGLIGIBLE = (10 * EPS) ** 2
# Singular values are never taken for less than this share of the largest one, so that no quotient divides by zero.
LEAST = 1e-30
# Singular values below this share of the largest one are rounding errors.
RANK = 1e-11
# Eigenvalues nearer to each other than this share are one cluster, whose vectors are made orthogonal.
CLUSTER = 1e-3


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V' for an orthogonal U and the upper bidiagonal B; r is square."""
    m = np.array(r, dtype=float)
    n = len(m)
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0:
            return None
        w = x.copy()
        w[0] += math.copysign(size, x[0])
        return w / np.linalg.norm(w)

    for k in range(n):
        w = reflector(m[k:, k])
        if w is not None:
            m[k:, k:] -= 2 * np.outer(w, w @ m[k:, k:])
        if k + 2 < n:
            w = reflector(m[k, k + 1 :])
            if w is not None:
                m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ w, w)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _transform(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds step; stops at the first negative pivot, so a shift that is too large gives a shorter list."""
    n = len(q)
    d = q[0] - tau
    new_q, new_e, pivots = [], [], [d]
    for k in range(n - 1):
        if d < 0:
            return new_q, new_e, pivots
        s = d + e[k]
        if s <= 0:
            s = 1e-300
        t = q[k + 1] / s
        new_q.append(s)
        new_e.append(e[k] * t)
        d = d * t - tau
        pivots.append(d)
    new_q.append(d)
    return new_q, new_e, pivots


def _guess(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows and columns."""
    a, b, c = q[-2] + e[-1], math.sqrt(e[-1] * q[-1]), q[-1]
    half = (a - c) / 2
    return c - b * b / (half + math.copysign(math.hypot(half, b), half or 1.0)) if b else min(a, c)


def squared_singular_values(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B, largest first; q and e are the squares of B's diagonal and superdiagonal."""
    found: list[float] = []
    blocks = [(list(q), list(e), 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        least, steps = 0.0, 0
        while q:
            n = len(q)
            if n == 1 or e[-1] <= NEGLIGIBLE * (sigma + q[-1]):
                found.append(sigma + q.pop())
                if e:
                    e.pop()
                least, steps = 0.0, 0
                continue
            cut = next((i for i in range(n - 1) if e[i] <= NEGLIGIBLE * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], sigma))
                q, e, least = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            steps += 1
            if steps > 500:
                raise ArithmeticError("dqds does not converge")
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            tau = max(_guess(q, e), least, 0.0)
            for _ in range(4):
                new_q, new_e, pivots = _transform(q, e, tau)
                if len(new_q) == n and pivots[-1] >= 0:
                    break
                # only the last pivot failed: the shift plus that pivot is a close lower bound; else a cautious one
                late = len(pivots) == n and tau + pivots[-1] > 0
                tau = (tau + pivots[-1]) * (1 - 4 * EPS) if late else max(tau / 4, least)
            else:
                tau = 0.0
                new_q, new_e, pivots = _transform(q, e, 0.0)
            q, e, sigma = new_q, new_e, sigma + tau
            # without a shift the pivots are the inverse's diagonal inverted, and its trace bounds the smallest value
            least = 0.0 if tau else 0.999 / sum(1 / max(d, 1e-300) for d in pivots)
    return sorted(found, reverse=True)


class _Twisted:
    """B'B - x factorised from both ends; the ends meet where the remaining pivot is smallest."""

    def __init__(self, q: np.ndarray, factor: np.ndarray, x: float):
        n = len(q)
        tiny = LEAST * max(q.max(), abs(x))

        def safe(value: float) -> float:
            return value if abs(value) > tiny else tiny

        self.top, self.low = np.empty(n), np.empty(n - 1)
        s = np.empty(n)
        s[0] = -x
        for i in range(n - 1):
            self.top[i] = safe(s[i] + q[i])
            self.low[i] = q[i] * factor[i] / self.top[i]
            s[i + 1] = self.low[i] * factor[i] * s[i] - x
        self.bottom, self.up = np.empty(n), np.empty(n - 1)
        p = np.empty(n)
        p[-1] = q[-1] - x
        for i in range(n - 2, -1, -1):
            self.bottom[i + 1] = safe(q[i] * factor[i] ** 2 + p[i + 1])
            t = q[i] / self.bottom[i + 1]
            self.up[i] = factor[i] * t
            p[i] = p[i + 1] * t - x
        gamma = s + p + x
        self.k = int(np.argmin(np.abs(gamma)))
        self.gamma = safe(float(gamma[self.k]))

    def vector(self) -> np.ndarray:
        """The vector that all equations but the one at the meeting place hold for."""
        z = np.zeros(len(self.top))
        z[self.k] = 1.0
        for i in range(self.k - 1, -1, -1):
            z[i] = -self.low[i] * z[i + 1]
        for i in range(self.k, len(z) - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, x: np.ndarray) -> np.ndarray:
        w, n, k = x.copy(), len(x), self.k
        for i in range(k):
            w[i + 1] -= self.low[i] * w[i]
        for i in range(n - 2, k - 1, -1):
            w[i] -= self.up[i] * w[i + 1]
        w[:k] /= self.top[:k]
        w[k] /= self.gamma
        w[k + 1 :] /= self.bottom[k + 1 :]
        for i in range(k - 1, -1, -1):
            w[i] -= self.low[i] * w[i + 1]
        for i in range(k, n - 1):
            w[i + 1] -= self.up[i] * w[i]
        return w / np.linalg.norm(w)


def _orthogonal(z: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """What is left of z beside ``others`` as a unit vector, and the share of z that this is."""
    share, size = 1.0, np.linalg.norm(z)
    for _ in range(3):
        for other in others:
            z = z - (other @ z) * other
        left = np.linalg.norm(z)
        share, size, z = share * left / size, 1.0, z / max(left, 1e-300)
    return z, share


def _another(twisted: _Twisted, z: np.ndarray, others: list[np.ndarray], rng: np.random.Generator) -> np.ndarray:
    """One more vector of a cluster: inverse iteration on what is orthogonal to ``others``."""
    best, most = z, -1.0
    for _ in range(12):
        rest, share = _orthogonal(z, others)
        if share > most:
            best, most = rest, share
        if share > 0.9:
            break
        # nothing of z is new: start anew from a random vector
        z = twisted.solve(rest if share > 1e-6 else _orthogonal(rng.standard_normal(len(z)), others)[0])
    return best


def _block_vectors(a: np.ndarray, b: np.ndarray, values: list[float]) -> list[np.ndarray]:
    """Unit eigenvectors of B'B for ``values`` (falling); no entry of b is zero."""
    if len(a) == 1:
        return [np.ones(1) for _ in values]
    q, factor = a * a, b / a[:-1]
    rng = np.random.default_rng(11)
    out: list[np.ndarray] = []
    start = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * values[i - 1]:
            start = i
        twisted = _Twisted(q, factor, value)
        z = twisted.vector()
        if i > start:
            z = _another(twisted, z, out[start:i], rng)
        out.append(z)
    return out


def right_singular(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, unit right singular vectors as columns) of ``r``: the largest ``most``, falling.

    Singular values of no more than ``RANK`` times the largest are left out.
    """
    n = r.shape[1]
    scale = np.abs(r).max() if r.size else 0.0
    if not scale:
        return np.zeros(0), np.zeros((n, 0))
    a, b, v = bidiagonalise(r / scale)
    largest = max(np.abs(a).max(), np.abs(b).max() if n > 1 else 0.0)
    a = np.where(np.abs(a) < LEAST * largest, LEAST * largest, a)
    b = np.where(np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:])), 0.0, b)
    cuts = [0, *(np.nonzero(b == 0)[0] + 1), n]
    pairs = []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        values = squared_singular_values(list(a[lo:hi] ** 2), list(b[lo : hi - 1] ** 2))
        pairs += [(value, lo, hi) for value in values]
    pairs.sort(key=lambda x: (-x[0], x[1]))
    top = [x for x in pairs[:most] if x[0] > RANK**2 * pairs[0][0]]
    vectors = np.zeros((n, len(top)))
    for lo, hi in sorted({(lo, hi) for _, lo, hi in top}):
        at = [i for i, x in enumerate(top) if x[1] == lo]
        found = _block_vectors(a[lo:hi], b[lo : hi - 1], [top[i][0] for i in at])
        for i, z in zip(at, found, strict=True):
            vectors[:, i] = v[:, lo:hi] @ z
    return np.array([x[0] for x in top]) * scale**2, vectors
