"""Eigenvalues and eigenvectors of a scatter matrix, kept up to date by rank-one changes.

Adding ``w * v v'`` to ``Q diag(values) Q'`` leaves a diagonal plus rank one.  Values that are equal are turned so that only one of
them meets the change, and values that the change hardly meets stay (deflation).  The new
values of the rest are the roots of the secular equation, one between any two old ones, found by interpolation with two poles
inside a bracket.  The change is then recomputed from the roots, so that the new vectors come out
orthogonal however close the roots lie.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

EPS = np.finfo(float).eps
# Steps of the root search; a bracket halves at the least, and most roots take six or seven.
STEPS = 200


def _first_guess(value, weight, width, origin, index, k):
    """Roots of the two poles around each interval and what the others add up to at its middle.  ``value`` is the
    function there."""
    up = np.minimum(index + 1, k - 1)
    here, there = weight[index], np.where(up > index, weight[up], 0.0)
    rest = value + (here - there) / (width / 2)
    # rest + here / -x + there / (width - x) = 0, with x counted from the lower pole.
    a, b = rest * width + here + there, here * width
    root = np.sqrt(np.maximum(a * a - 4 * rest * b, 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.where(a <= 0, (a - root) / (2 * rest), 2 * b / (a + root))
    return np.where(origin > index, x - width, x)


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z ** 2 / (d - x))`` for ascending ``d``: for each the index of the nearer ``d``
    and how far from it the root lies."""
    k = len(d)
    weight = rho * z * z
    if k == 1:
        return np.zeros(1, dtype=int), weight.copy()
    index = np.arange(k)
    apart = d[:, None] - d[None, :]
    width = np.append(np.diff(d), weight.sum())
    value = 1 + (weight[:, None] / (apart - width / 2)).sum(axis=0)
    right = value < 0
    origin = np.where(right, np.minimum(index + 1, k - 1), index)
    last = np.arange(k) == k - 1
    low = np.where(right & ~last, -width / 2, np.where(right, width / 2, 0.0))
    high = np.where(right & ~last, 0.0, np.where(right, width, width / 2))
    base = apart[:, origin]
    one = np.minimum(index, k - 2)  # the pole below, or for the last root the two largest ones
    below = index[:, None] <= one[None, :]
    t = _first_guess(value, weight, width, origin, index, k)
    t = np.where((t > low) & (t < high), t, (low + high) / 2)
    for _ in range(STEPS):
        gap = base - t
        inverse = 1 / gap
        squared = inverse * inverse
        f, slope = 1 + weight @ inverse, weight @ squared
        # As exact as f can be told: its terms and the root's own last digit.
        done = np.abs(f) <= 8 * EPS * (1 + weight @ np.abs(inverse) + np.abs(t) * slope)
        if done.all() or (done | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))).all():
            break
        low, high = np.where(f < 0, t, low), np.where(f < 0, high, t)
        psi = weight @ (squared * below)
        phi = slope - psi
        p, q = gap[one, index], gap[one + 1, index]
        c = f - p * psi - q * phi
        a = (p + q) * f - p * q * (psi + phi)
        b = p * q * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            inner = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            outer = np.where(a >= 0, (a + root) / (2 * c), 2 * b / (a - root))
        step = t + np.where(last, outer, inner)
        t = np.where(done, t, np.where((step > low) & (step < high), step, (low + high) / 2))
    return origin, t


@dataclass
class Spectrum:
    """What a set of rows adds up to: how many, their sums (exact), their mean, and the eigenvalues
    (ascending) and eigenvectors (columns) of their centred scatter matrix."""
    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, [0] * width, np.zeros(width), np.zeros(width), np.eye(width))

    def widened(self, width: int) -> Spectrum:
        """The same rows with zeros behind their entries."""
        more = width - len(self.mean)
        if more <= 0:
            return self
        vectors = np.eye(width)
        vectors[:len(self.mean), :len(self.mean)] = self.vectors
        out = Spectrum(self.n, self.sums + [0] * more, np.append(self.mean, np.zeros(more)), np.append(self.values, np.zeros(more)), vectors)
        out._sort()
        return out

    def _sort(self) -> None:
        if (np.diff(self.values) < 0).any():
            order = np.argsort(self.values, kind="stable")
            self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _change(self, v: np.ndarray, weight: float) -> None:
        """The spectrum of the scatter matrix plus ``weight * v v'``."""
        z = v @ self.vectors
        size = float(np.sqrt(z @ z))
        rho = weight * size * size
        if not rho > 0:
            return
        z = z / size
        values, vectors = self.values, self.vectors
        near = 8 * EPS * max(values[-1], rho)
        same = np.diff(values) <= near
        if same.any():  # turn equal values so that the last of them meets the change alone
            edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
            for a, b in zip(edge[::2].tolist(), (edge[1::2] + 1).tolist()):
                part = z[a:b]
                length = float(np.sqrt(part @ part))
                if length > 0:
                    w = part.copy()
                    w[-1] += np.copysign(length, part[-1])
                    vectors[:, a:b] -= np.outer(vectors[:, a:b] @ w, w) * (2 / (w @ w))
                    end = -np.copysign(length, part[-1])
                    z[a:b] = 0
                    z[b - 1] = end
        live = np.flatnonzero(np.abs(rho * z) > near)
        if not len(live):
            return
        d, z = values[live], z[live]
        origin, t = secular_roots(d, z, rho)
        gap = (d[:, None] - d[origin]) - t
        apart = d[None, :] - d[:, None]
        np.fill_diagonal(apart, 1)
        change = np.sqrt(np.abs(np.prod(-gap / apart, axis=1))) * np.sign(z)
        gap[gap == 0] = np.finfo(float).tiny
        turn = change[:, None] / gap
        turn /= np.sqrt((turn * turn).sum(axis=0))
        vectors[:, live] = vectors[:, live] @ turn
        values[live] = d[origin] + t
        self._sort()

    def add(self, row: np.ndarray, times: int, exact: list[int]) -> None:
        """Take in a row that stands ``times`` times."""
        off = row - self.mean
        total = self.n + times
        self._change(off, self.n * times / total)
        self.mean = self.mean + off * (times / total)
        self.n = total
        self.sums = [s + times * x for s, x in zip(self.sums, exact)]

    def merge(self, other: Spectrum) -> Spectrum:
        """Both sets of rows, by one change per eigenvector of the smaller and one for the means."""
        if self.n < other.n:
            return other.merge(self)
        width = max(len(self.mean), len(other.mean))
        out, other = self.widened(width), other.widened(width)
        if not other.n:
            return out
        for value, vector in zip(other.values.tolist(), other.vectors.T):
            if value > 0:
                out._change(vector, value)
        off, total = other.mean - out.mean, out.n + other.n
        out._change(off, out.n * other.n / total)
        out.mean = out.mean + off * (other.n / total)
        out.n, out.sums = total, [a + b for a, b in zip(out.sums, other.sums)]
        return out

    def packed(self) -> bytes:
        head = json.dumps([self.n, self.sums]).encode()
        return len(head).to_bytes(4, "big") + head + np.concatenate([self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Spectrum:
        end = 4 + int.from_bytes(data[:4], "big")
        n, sums = json.loads(data[4:end])
        rest, d = np.frombuffer(data[end:]).copy(), len(sums)
        return cls(n, sums, rest[:d], rest[d:2 * d], rest[2 * d:].reshape(d, d))
