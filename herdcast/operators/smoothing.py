"""Local linear trend (level and slope) of daily series, parallel in time, used inside tasks.

State x = (level, slope): x_t = T x_(t-1) + w, w ~ N(0, diag(q1, q2)); a reading is the level plus noise of variance r.
A block of days is summed up as an *element*: given the state x before it, the state at its end is N(A x + b, C), and the
readings' likelihood is exp(-(c - 2 h'x + x'J x + logdet) / 2). Elements of successive blocks compose, so a series
spans any number of tasks: blocks are filtered from nothing, their elements are composed in a scan over few rows, and every
block is then smoothed with the state before it and the information after it.

All functions work on arrays (series or candidates first), so that a block's measures and variances run side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP = np.array([[1.0, 1.0], [0.0, 1.0]])
DIFFUSE = 1e7                   # variance of both states before the first day
SIZE = 17                       # numbers of an element
RATIOS = ((-14.0, 6.0), (-24.0, 2.0))     # log of q1 and q2 over r that are searched
GRID, ROUNDS = 9, 4


@dataclass
class Element:
    A: np.ndarray
    b: np.ndarray
    C: np.ndarray
    h: np.ndarray
    J: np.ndarray
    c: np.ndarray
    logdet: np.ndarray
    n: np.ndarray

    def pack(self) -> np.ndarray:
        """One row per series; the count of readings takes the place of J's lower corner, which is its upper one."""
        J = self.J.reshape(-1, 4).copy()
        J[:, 2] = self.n
        return np.column_stack([self.A.reshape(-1, 4), self.b, self.C.reshape(-1, 4)[:, [0, 1, 3]], self.h, J, self.c, self.logdet])

    @staticmethod
    def unpack(rows: np.ndarray) -> Element:
        A, b, C, h, J, c, logdet = np.split(rows, [4, 6, 9, 11, 15, 16], axis=1)
        n = J[:, 2].copy()
        return Element(A.reshape(-1, 2, 2), b, C[:, [0, 1, 1, 2]].reshape(-1, 2, 2), h, J[:, [0, 1, 1, 3]].reshape(-1, 2, 2),
                       c[:, 0], logdet[:, 0], n)


def _times(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.einsum("kij,kj->ki", m, v)


def filter_block(y: np.ndarray, r: np.ndarray, q: np.ndarray) -> Element:
    """The element of a block: ``y`` days x series (NaN: no reading), ``r`` noise and ``q`` (level, slope) variances by series."""
    k = len(r)
    one, zero = np.ones(k), np.zeros(k)
    a00, a01, a10, a11, b0, b1, c00, c01, c11 = one, zero, zero, one, zero, zero, zero, zero, zero
    h0, h1, j00, j01, j11, c, logdet, n = (np.zeros(k) for _ in range(8))
    for day in y:
        a00, a01, b0 = a00 + a10, a01 + a11, b0 + b1        # a day on
        c00, c01, c11 = c00 + 2 * c01 + c11 + q[:, 0], c01 + c11, c11 + q[:, 1]
        seen = ~np.isnan(day)
        s = c00 + r
        gain = np.where(seen, 1.0 / s, 0.0)                 # no reading: nothing is gained
        left = np.where(seen, day - b0, 0.0)
        g0, g1, told = a00 * gain, a01 * gain, left * gain
        c += left * told
        h0 += a00 * told
        h1 += a01 * told
        j00 += a00 * g0
        j01 += a00 * g1
        j11 += a01 * g1
        logdet += np.where(seen, np.log(s), 0.0)
        n += seen
        a10, a11 = a10 - c01 * g0, a11 - c01 * g1
        a00, a01 = a00 - c00 * g0, a01 - c00 * g1
        b0, b1 = b0 + c00 * told, b1 + c01 * told
        keep = np.where(seen, r / s, 1.0)                   # 1 - c00 / s without cancellation
        c11 = c11 - c01 * c01 * gain
        c00, c01 = c00 * keep, c01 * keep
    return Element(np.stack([a00, a01, a10, a11], 1).reshape(-1, 2, 2), np.stack([b0, b1], 1), np.stack([c00, c01, c01, c11], 1).reshape(-1, 2, 2),
                   np.stack([h0, h1], 1), np.stack([j00, j01, j01, j11], 1).reshape(-1, 2, 2), c, logdet, n)


def likelihood(e: Element, m: np.ndarray, P: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quadratic form and log-determinant of a block's readings if the state before it is N(m, P)."""
    inner = np.eye(2) + P @ e.J
    d = e.h - _times(e.J, m)
    quad = e.c - 2 * (e.h * m).sum(1) + (m * _times(e.J, m)).sum(1) - (d * np.linalg.solve(inner, _times(P, d)[..., None])[..., 0]).sum(1)
    return quad, e.logdet + np.linalg.slogdet(inner)[1]


def forward(e: Element, m: np.ndarray, P: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State after a block, given its readings and N(m, P) before it."""
    inner = np.linalg.inv(np.eye(2) + P @ e.J)
    own = _times(inner, m + _times(P, e.h))
    return _times(e.A, own) + e.b, e.A @ (inner @ P) @ e.A.transpose(0, 2, 1) + e.C


def backward(e: Element, h: np.ndarray, J: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Information about the state before a block, from the block and from (h, J) about the state after it."""
    inner = e.A.transpose(0, 2, 1) @ np.linalg.inv(np.eye(2) + J @ e.C)
    return e.h + _times(inner, h - _times(J, e.b)), e.J + inner @ J @ e.A


def start(k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros((k, 2)), np.tile(np.eye(2) * DIFFUSE, (k, 1, 1))


def profile(blocks: list[Element]) -> np.ndarray:
    """-2 log likelihood of a whole series with its scale at the best value, blocks in order."""
    m, P = start(len(blocks[0].c))
    quad = logdet = n = 0.0
    for e in blocks:
        a, d = likelihood(e, m, P)
        quad, logdet, n = quad + a, logdet + d, n + e.n
        m, P = forward(e, m, P)
    free = np.maximum(n - 2, 1)                              # two readings settle the start
    return logdet + free * np.log(np.maximum(quad / free, 1e-12))


def ends(blocks: list[Element]) -> list[np.ndarray]:
    """For each block a row per series: state before it (m, P) and information after it (h, J)."""
    k = len(blocks[0].c)
    before, after = [start(k)], [(np.zeros((k, 2)), np.zeros((k, 2, 2)))]
    for e in blocks[:-1]:
        before.append(forward(e, *before[-1]))
    for e in reversed(blocks[1:]):
        after.append(backward(e, *after[-1]))
    return [np.column_stack([m, P.reshape(k, 4), h, J.reshape(k, 4)])
            for (m, P), (h, J) in zip(before, reversed(after), strict=True)]


def smooth_block(y: np.ndarray, r: np.ndarray, q: np.ndarray, ends_: np.ndarray) -> np.ndarray:
    """Days x series: readings as they are, smoothed levels where there are none."""
    m, P, h, J = (x.reshape(len(r), *s) for x, s in zip(np.split(ends_, [2, 6, 8], axis=1), ((2,), (2, 2), (2,), (2, 2)), strict=True))
    states = []
    for day in y:
        m, P = m @ STEP.T, STEP @ P @ STEP.T
        P[:, 0, 0] += q[:, 0]
        P[:, 1, 1] += q[:, 1]
        seen = ~np.isnan(day)
        gain = P[:, :, 0] * np.where(seen, 1.0 / (P[:, 0, 0] + r), 0.0)[:, None]
        m = m + gain * np.where(seen, day - m[:, 0], 0.0)[:, None]
        P = P - gain[:, :, None] * P[:, 0, :][:, None, :]
        states.append((m, P))
    out = y.copy()
    for t in range(len(y) - 1, -1, -1):
        m, P = states[t]
        seen = ~np.isnan(y[t])
        if not seen.all():
            level = np.linalg.solve(np.eye(2) + P @ J, (m + _times(P, h))[..., None])[:, 0, 0]
            out[t] = np.where(seen, y[t], level)
        J, h = J.copy(), h.copy()
        J[:, 0, 0] += np.where(seen, 1.0 / r, 0.0)
        h[:, 0] += np.where(seen, y[t] / r, 0.0)
        noise = np.eye(2) + J * q[:, None, :]                # I + J Q
        inner = STEP.T @ np.linalg.inv(noise)
        h, J = _times(inner, h), inner @ J @ STEP
    return out


def candidates(center: np.ndarray | None, round_: int) -> np.ndarray:
    """Pairs of log ratios to try: the whole range first, then a finer grid around the best."""
    axes = []
    for i, (lo, hi) in enumerate(RATIOS):
        half = (hi - lo) / 2 / ((GRID - 1) / 2) ** round_
        middle = (lo + hi) / 2 if center is None else float(center[i])
        axes.append(np.clip(np.linspace(middle - half, middle + half, GRID), lo, hi))
    return np.stack(np.meshgrid(*axes, indexing="ij"), -1).reshape(-1, 2)
