"""Eigendecompositions kept up to date by rank-one changes (numpy, one partition at a time).

A spectrum is the state of a list of vectors: their number, their mean, and
the eigenvalues and unit eigenvectors of their scatter (the sum of outer
products of centred vectors). Only directions with spread are held.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = np.finfo(np.float64).eps
STEPS = 80               # bound on root steps; brackets halve at the latest every other step


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(w / (d - x)) = 0 for rising d and w > 0, as gaps.

    Root i lies between d[i] and d[i + 1] (the last one below d[-1] + sum(w)).
    Returned are the roots and the matrix gap[j, i] = d[j] - root[i]. Each
    root is sought as an offset from the pole nearest to it, so gaps keep full relative
    precision. A step fits one pole on each side to the function and its
    slope; a step that leaves the bracket is replaced by the bracket's middle.
    """
    k = len(d)
    upper = np.append(d[1:], d[-1] + w.sum())
    idx = np.arange(k)
    mid = (upper - d) / 2
    f_mid = 1 + (w[:, None] / ((d[:, None] - d[None, :]) - mid[None, :])).sum(axis=0)
    left = (f_mid >= 0) | (idx == k - 1)                     # the nearer pole; the last root has one only
    origin = np.where(left, idx, np.minimum(idx + 1, k - 1))
    delta = d[:, None] - d[origin][None, :]                  # pole j seen from the origin of root i
    low = np.where(left, 0.0, -mid)
    high = np.where(left, np.where(idx == k - 1, upper - d, mid), 0.0)
    mu = (low + high) / 2
    below = idx[:, None] <= idx[None, :]
    near = delta[idx, idx]
    far = np.where(idx == k - 1, upper - d, delta[np.minimum(idx + 1, k - 1), idx])
    for step in range(STEPS):
        gap = delta - mu[None, :]
        term = w[:, None] / gap
        slope = term / gap
        f = 1 + term.sum(axis=0)
        size = 1 + np.abs(term).sum(axis=0)
        done = np.abs(f) <= 4 * EPS * size
        low = np.where(f < 0, mu, low)
        high = np.where(f >= 0, mu, high)
        if (done | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))).all():
            break
        psi = np.where(below, slope, 0).sum(axis=0)
        phi = slope.sum(axis=0) - psi
        g1, g2 = near - mu, far - mu
        a = (g1 + g2) * f - g1 * g2 * (psi + phi)
        b = g1 * g2 * f
        c = f - g1 * psi - g2 * phi
        with np.errstate(all="ignore"):
            s = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            move = np.where(a <= 0, (a - s) / (2 * c), 2 * b / (a + s))
        new = mu + move
        bad = ~np.isfinite(new) | (new <= low) | (new >= high)
        if step % 2:                                         # slow brackets are halved on odd steps
            bad |= ~done & (high - low > 0.5 * np.abs(high + low)) & (step > 12)
        mu = np.where(done, mu, np.where(bad, (low + high) / 2, new))
    gap = delta - mu[None, :]
    return d[origin] + mu, gap


def rank_one(values: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``vectors diag(values) vectors' + change change'``.

    The part of the change outside the held directions becomes a direction
    of its own. Deflation: a direction the change does not touch keeps its pair, and of two
    equal eigenvalues one is turned out of the change. The other
    eigenvalues are roots of the secular equation; the change is then
    computed anew from the roots, which keeps the eigenvectors orthogonal.
    """
    norm = float(np.linalg.norm(change))
    if norm == 0.0:
        return values, vectors
    z = vectors.T @ change
    rest = change - vectors @ z
    again = vectors.T @ rest
    rest -= vectors @ again
    z = z + again
    out = float(np.linalg.norm(rest))
    if out > 64 * EPS * norm and vectors.shape[1] < vectors.shape[0]:
        values = np.append(values, 0.0)
        vectors = np.column_stack([vectors, rest / out])
        z = np.append(z, out)
    order = np.argsort(values, kind="stable")
    d, q, z = values[order], vectors[:, order], z[order]

    tol = 8 * EPS * max(float(d[-1]), norm * norm)
    live = np.abs(z) * norm > tol
    last = -1
    for i in np.flatnonzero(live):                           # equal eigenvalues: turn one out of the change
        if last >= 0:
            r = float(np.hypot(z[last], z[i]))
            c, s = z[i] / r, z[last] / r
            if abs((d[i] - d[last]) * c * s) <= tol:
                q[:, last], q[:, i] = c * q[:, last] - s * q[:, i], s * q[:, last] + c * q[:, i]
                d[last], d[i] = c * c * d[last] + s * s * d[i], s * s * d[last] + c * c * d[i]
                z[last], z[i] = 0.0, r
                live[last] = False
        last = i
    at = np.flatnonzero(live)
    if len(at):
        dl, zl = d[at], z[at]
        k = len(at)
        roots, gap = secular_roots(dl, zl * zl)
        between = dl[None, :] - dl[:, None]                  # between[i, j] = d[j] - d[i]
        np.fill_diagonal(between, 1.0)
        ratio = np.empty((k, k))                             # ratio[i, j]: factor of root j in the square of entry i
        lower = np.tril(np.ones((k, k), dtype=bool), -1)
        ratio[lower] = (-gap / between)[lower]
        upper = ~lower
        upper[:, -1] = False
        nxt = np.empty((k, k))
        nxt[:, :-1] = between[:, 1:]
        nxt[:, -1] = 1.0
        ratio[upper] = (-gap / nxt)[upper]
        ratio[:, -1] = -gap[:, -1]
        fresh = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.where(zl < 0, -1.0, 1.0)
        u = fresh[:, None] / gap
        u /= np.linalg.norm(u, axis=0)
        d[at] = roots
        q[:, at] = q[:, at] @ u
    return d, q


@dataclass
class Spectrum:
    """Number, mean and scatter eigenpairs of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(0), np.zeros((dim, 0)))

    def add(self, x: np.ndarray) -> None:
        """One more vector: a centred rank-one update."""
        off = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, n: int, mean: np.ndarray, directions: np.ndarray) -> None:
        """Vectors given by number, mean and rows whose outer products sum to their scatter: a rank-one update a row."""
        if n == 0:
            return
        for row in directions:
            self.values, self.vectors = rank_one(self.values, self.vectors, row)
        off = mean - self.mean
        total = self.n + n
        self.values, self.vectors = rank_one(self.values, self.vectors, off * np.sqrt(self.n * n / total))
        self.n, self.mean = total, self.mean + off * (n / total)

    def add_block(self, x: np.ndarray) -> None:
        """Several vectors. A block of more rows than dimensions is first turned
        (QR of the centred block) into one direction a dimension with the same scatter."""
        if len(x) <= x.shape[1]:
            for row in x:
                self.add(row)
            return
        mean = x.mean(axis=0)
        self.merge(len(x), mean, np.linalg.qr(x - mean, mode="r"))

    def combine(self, other: Spectrum) -> None:
        """The spectrum of both lists, by a rank-one update for each direction of the other."""
        self.merge(other.n, other.mean, (other.vectors * np.sqrt(np.maximum(other.values, 0))).T[::-1])

    def pack(self) -> list[float]:
        return [float(self.n), float(len(self.mean)), float(len(self.values)), *self.mean.tolist(),
                *self.values.tolist(), *self.vectors.ravel().tolist()]

    @classmethod
    def unpack(cls, flat) -> Spectrum:
        flat = np.asarray(flat, dtype=np.float64)
        n, dim, r = int(flat[0]), int(flat[1]), int(flat[2])
        at = 3 + dim
        return cls(n, flat[3:at].copy(), flat[at:at + r].copy(), flat[at + r:at + r + dim * r].reshape(dim, r).copy())
