"""Eigendecompositions that grow by rank-one updates.

Adding ``weight * v v'`` to a matrix with known eigenvalues d and eigenvectors U changes
the eigenvalues to the roots of the secular equation 1 + rho * sum(z_i^2 / (d_i - mu)) = 0,
z = U'v normalised: one root in each gap between neighbouring d. Entries of z that don't
count, and entries of equal d (turned into one by a rotation), are deflated: their pairs
stay as they are. The roots are kept as offsets from the nearer pole, and z is computed
anew from them, so the new vectors are orthogonal to working precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = float(np.finfo(np.float64).eps)
_ROUNDS = 100


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pole and offset from it, for each root; d ascends strictly, z2 and rho are positive.

    Each step fits one pole on either side to the sums left and right of the root (value and
    slope) and takes the root of that; a step that leaves the bracket becomes a bisection.
    """
    k = len(d)
    at = np.arange(k)
    gap = np.append(d[1:] - d[:-1], rho * z2.sum())
    half = gap / 2
    square = z2[:, None]
    apart = d[:, None] - d[None, :]
    middle = 1 + rho * (square / (apart - half)).sum(0)
    near = (middle >= 0) | (at == k - 1)
    pole = np.where(near, at, at + 1)
    low = np.where(near, 0.0, -half)
    high = np.where(near, half, 0.0)
    if middle[-1] < 0:
        low[-1], high[-1] = half[-1], gap[-1]
    apart = d[:, None] - d[pole][None, :]
    left = np.triu(np.ones((k, k)))
    own, after = apart[at, at], np.append(apart[at[1:], at[:-1]], 0.0)
    x = (low + high) / 2
    for _ in range(_ROUNDS):
        distance = apart - x
        term = square / distance
        slope = term / distance
        psi, dpsi = np.einsum("ij,ij->j", term, left), np.einsum("ij,ij->j", slope, left)
        phi, dphi = term.sum(0) - psi, slope.sum(0) - dpsi
        f = 1 + rho * (psi + phi)
        close = np.abs(f) <= k * EPS * (1 + rho * (phi - psi))
        if close.all():
            break
        low, high = np.where(f < 0, x, low), np.where(f > 0, x, high)
        a, b = own - x, after - x
        s, t = rho * dpsi * a * a, rho * dphi * b * b
        c = 1 + rho * (psi - dpsi * a + phi - dphi * b)
        p, q = c * (a + b) + s + t, c * a * b + s * b + t * a
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(p * p - 4 * c * q, 0))
            step = np.where(p > 0, 2 * q / (p + root), (p - root) / (2 * c))
            last = 1 + rho * (psi[-1] - dpsi[-1] * a[-1])
            step[-1] = a[-1] + s[-1] / last
            new = x + step
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
        x = np.where(close, x, new)
    return pole, x


def _grown(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of diag(d) + rho z z'."""
    pole, x = secular_roots(d, z * z, rho)
    beyond = x - (d[:, None] - d[pole][None, :])  # root j minus d_i
    apart = d[None, :] - d[:, None]
    np.fill_diagonal(apart, 1.0)
    exact = np.sqrt(np.abs(np.prod(beyond / apart, axis=1)) / rho)
    vectors = np.copysign(exact, z)[:, None] / -beyond
    return d[pole] + x, vectors / np.sqrt((vectors * vectors).sum(0))


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of u diag(d) u' + weight v v', weight >= 0."""
    z = u.T @ v
    size = float(z @ z)
    rho = weight * size
    if not rho > 0:
        return d, u
    z = z / np.sqrt(size)
    tolerance = 8 * EPS * max(float(np.abs(d).max()), rho)
    live = rho * np.abs(z) > tolerance
    at = np.flatnonzero(live)
    first, second = at[:-1], at[1:]
    turn = np.hypot(z[first], z[second])
    if len(first) and ((d[second] - d[first]) * np.abs(z[first] * z[second]) <= tolerance * turn * turn).any():
        d, u, z = d.copy(), u.copy(), z.copy()
        p = at[0]
        for j in at[1:]:
            r = np.hypot(z[p], z[j])
            c, s = z[j] / r, z[p] / r
            if (d[j] - d[p]) * abs(c * s) <= tolerance:
                u[:, p], u[:, j] = c * u[:, p] - s * u[:, j], s * u[:, p] + c * u[:, j]
                d[p], d[j] = d[p] * c * c + d[j] * s * s, d[p] * s * s + d[j] * c * c
                z[p], z[j], live[p] = 0.0, r, False
            p = j
        at = np.flatnonzero(live)
        # The rotations may leave the kept values out of order by rounding.
        at = at[np.argsort(d[at], kind="stable")]
    if not len(at):
        return d, u
    values, turned = _grown(d[at], z[at], rho)
    d, u = d.copy(), u.copy()
    d[at], u[:, at] = values, u[:, at] @ turned
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


@dataclass
class Spectrum:
    """Rows seen so far: how many, their mean (``base`` + ``offset``), eigenpairs of their centred scatter."""

    n: int
    base: np.ndarray  # whole numbers
    offset: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, base: np.ndarray) -> Spectrum:
        size = len(base)
        return cls(0, base.astype(np.int64), np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, row: np.ndarray) -> None:
        """A centred rank-one update by one row of whole numbers."""
        away = (row - self.base).astype(np.float64) - self.offset
        self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n / (self.n + 1))
        self.n += 1
        self.offset = self.offset + away / self.n

    def merge(self, other: Spectrum) -> None:
        """The rows of ``other``: its eigenpairs one after the other, then the way between the means."""
        if not other.n:
            return
        least = EPS * max(float(other.values[-1]), 0.0)
        for k in np.flatnonzero(other.values > least):
            self.values, self.vectors = rank_one(self.values, self.vectors, other.vectors[:, k], float(other.values[k]))
        away = (other.base - self.base).astype(np.float64) + other.offset - self.offset
        n = self.n + other.n
        self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * other.n / n)
        self.offset = self.offset + away * (other.n / n)
        self.n = n
