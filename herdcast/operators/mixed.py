"""Random-intercept models by REML from distributed sufficient statistics.

With rows v = [X, y] and weights w, everything the likelihood needs is

* one Gram matrix A = sum w v v', and
* per random-intercept group (a location-year, or an animal) s = sum w v and W = sum w.

For a variance ratio t (group variance over residual variance) the group terms enter as
sums over groups of t/(1+tW) s s', s/(1+tW), W/(1+tW) and log(1+tW). As functions of log t
these sums are analytic, so they are evaluated once at Chebyshev nodes, in one distributed
pass, and interpolated for any other t. Searching for the best ratio then needs no further
pass over the data, whether for the full model, for every leave-one-out refit, or for each
round of an iterative fit.

A second random intercept (Year) that contains the groups has few levels and is resolved
exactly from the per-year sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_NODES = 96
SCALED_RANGE = (1e-4, 1e6)     # ratio times mean group weight
SALTS = 16
SPREAD, SPREAD_OVER = "_part", 64


# ----------------------------------------------------------------- numeric core (small arrays)
def chebyshev_nodes(mean_weight: float, n: int = N_NODES) -> np.ndarray:
    """Log-ratio nodes for groups of the given mean weight."""
    lo, hi = np.log(SCALED_RANGE[0] / mean_weight), np.log(SCALED_RANGE[1] / mean_weight)
    k = np.arange(n)
    return (lo + hi) / 2 + (hi - lo) / 2 * np.cos((2 * k + 1) * np.pi / (2 * n))


def interpolation_weights(nodes: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Barycentric weights taking values at the nodes to values at each ``t``."""
    n = len(nodes)
    k = np.arange(n)
    bary = (-1.0) ** k * np.sin((2 * k + 1) * np.pi / (2 * n))
    diff = t[:, None] - nodes[None, :]
    exact = np.abs(diff) < 1e-13
    w = bary / np.where(exact, 1.0, diff)
    out = w / w.sum(axis=1, keepdims=True)
    hit = exact.any(axis=1)
    out[hit] = exact[hit].astype(float)
    return out


def group_terms(s: np.ndarray, w: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Node-wise [sum t/(1+tW) ss', sum s/(1+tW), sum W/(1+tW), sum log(1+tW)] of some groups."""
    q = s.shape[1]
    out = np.empty((len(nodes), q * q + q + 2))
    for m, t in enumerate(np.exp(nodes)):
        shrink = 1.0 / (1.0 + t * w)
        out[m, : q * q] = (s.T @ (s * (t * shrink)[:, None])).ravel()
        out[m, q * q: q * q + q] = shrink @ s
        out[m, -2] = shrink @ w
        out[m, -1] = np.log1p(t * w).sum()
    return out


def independent_columns(gram: np.ndarray, tol: float = 1e-10, scale: np.ndarray | None = None) -> list[int]:
    """Columns kept, first come first kept, when linearly dependent ones are left out.

    ``scale`` is the diagonal that remainders are compared with, if ``gram`` has been reduced already.
    """
    a = gram.astype(float).copy()
    scale = np.diag(gram).copy() if scale is None else scale
    keep = []
    for j in range(len(a)):
        if scale[j] > 0 and a[j, j] > tol * scale[j]:
            keep.append(j)
            a = a - np.outer(a[:, j], a[j, :]) / a[j, j]
    return keep


@dataclass
class Moments:
    """Sums the likelihood needs. ``years`` maps a level to its (nodes x (q+1)) B and W sums."""

    gram: np.ndarray
    n: float
    log_w: float
    terms: np.ndarray                       # nodes x (q*q + 1): corrections and log-determinant
    by_year: np.ndarray                     # years x nodes x (q + 1)
    flat_by_year: np.ndarray                # years x (q + 1): the same sums at ratio zero
    year_names: list = field(default_factory=list)


@dataclass
class Fit:
    beta: np.ndarray                        # NaN where a dependent column was left out
    sigma2: float
    ratio_group: float
    ratio_year: float
    year_effect: dict
    criterion: float


class Problem:
    """REML criterion of one data set as a function of the two variance ratios."""

    def __init__(self, m: Moments, p: int, nodes: np.ndarray, use_group: bool, use_year: bool,
                 columns: Sequence[int] | None = None):
        self.m, self.nodes, self.p = m, nodes, p
        self.q = m.gram.shape[0]
        self.use_group, self.use_year = use_group, use_year
        self.keep = list(columns) if columns is not None else independent_columns(m.gram[:p, :p])
        self.pick = np.array(self.keep + [self.q - 1])

    def _at(self, t: np.ndarray):
        """A, B, W and log-determinant at log-ratios ``t`` (-inf is ratio zero)."""
        zero = np.isneginf(t)
        w = interpolation_weights(self.nodes, np.where(zero, self.nodes[0], t))
        w[zero] = 0.0
        terms = np.einsum("tn,nk->tk", w, self.m.terms)
        a = self.m.gram[None] - terms[:, :-1].reshape(len(t), self.q, self.q)
        by = np.einsum("tn,ynk->tyk", w, self.m.by_year)
        by[zero] = self.m.flat_by_year[None]
        return a, by[:, :, :-1], by[:, :, -1], terms[:, -1]

    def moments(self, t: float, u: float):
        """X'V^-1X and friends (kept columns, response last), and log|V|."""
        mats, dets = self._grid(np.array([t]), np.array([u]))
        return mats[0, 0], float(dets[0, 0])

    def _grid(self, t: np.ndarray, u: np.ndarray):
        a, b, wy, det = self._at(t)
        ix = self.pick
        a, b = a[:, ix][:, :, ix], b[:, :, ix]
        ry = np.where(np.isneginf(u), 0.0, np.exp(np.where(np.isneginf(u), 0.0, u)))
        k = ry[None, :, None] / (1.0 + ry[None, :, None] * wy[:, None, :])
        mats = a[:, None] - np.einsum("tuy,tyi,tyj->tuij", k, b, b)
        dets = det[:, None] + np.log1p(ry[None, :, None] * wy[:, None, :]).sum(axis=2)
        return mats, dets - self.m.log_w

    def criterion(self, t: np.ndarray, u: np.ndarray) -> np.ndarray:
        mats, dets = self._grid(t, u)
        xx, xy, yy = mats[..., :-1, :-1], mats[..., :-1, -1], mats[..., -1, -1]
        sign, logdet = np.linalg.slogdet(xx)
        beta = np.linalg.solve(xx, xy[..., None])[..., 0]
        df = self.m.n - len(self.keep)
        s2 = (yy - (xy * beta).sum(-1)) / df
        good = (sign > 0) & (s2 > 0)
        return np.where(good, dets + logdet + df * np.log(np.where(good, s2, 1.0)), np.inf)

    def optimum(self) -> Fit:
        zero = np.array([-np.inf])
        lo, hi = self.nodes[-1], self.nodes[0]
        t = np.linspace(lo, hi, 25) if self.use_group else zero
        wy = max(float(self.m.flat_by_year[:, -1].mean()), 1e-12) if self.use_year else 1.0
        u = np.linspace(np.log(1e-7 / wy), np.log(1e6 / wy), 25) if self.use_year else zero
        best_t, best_u, value = self._search(t, u, lo, hi)
        options = [(best_t, best_u, value)]
        if self.use_group:
            options.append(self._search(zero, u, lo, hi))
        if self.use_year:
            options.append(self._search(t, zero, lo, hi))
        if self.use_group and self.use_year:
            options.append(self._search(zero, zero, lo, hi))
        # a ratio of exactly zero wins ties: that is the singular fit
        options.sort(key=lambda o: (round(o[2], 9), o[0] + o[1]))
        return self.solve(*options[0])

    def _search(self, t: np.ndarray, u: np.ndarray, lo: float, hi: float):
        step_t = t[1] - t[0] if len(t) > 1 else 0.0
        step_u = u[1] - u[0] if len(u) > 1 else 0.0
        for _ in range(14):
            values = self.criterion(t, u)
            i, j = np.unravel_index(np.argmin(values), values.shape)
            best = float(t[i]), float(u[j]), float(values[i, j])
            if step_t:
                t = np.clip(np.linspace(best[0] - step_t, best[0] + step_t, 7), lo, hi)
            if step_u:
                u = np.linspace(best[1] - step_u, best[1] + step_u, 7)
            step_t, step_u = step_t / 3, step_u / 3
        return best

    def solve(self, t: float, u: float, value: float) -> Fit:
        mat, _ = self.moments(t, u)
        kept = np.linalg.solve(mat[:-1, :-1], mat[:-1, -1])
        s2 = (mat[-1, -1] - mat[:-1, -1] @ kept) / (self.m.n - len(self.keep))
        beta = np.full(self.p, np.nan)
        beta[self.keep] = kept
        ratio_y = 0.0 if np.isneginf(u) else float(np.exp(u))
        _, b, wy, _ = self._at(np.array([t]))
        full = np.append(-np.nan_to_num(beta), 1.0)
        effect = ratio_y / (1 + ratio_y * wy[0]) * (b[0][:, np.r_[0:self.p, self.q - 1]] @ full)
        seen = self.m.flat_by_year[:, -1] > 1e-9
        years = {y: float(e) for y, e, s in zip(self.m.year_names, effect, seen) if s}
        return Fit(beta, float(s2), 0.0 if np.isneginf(t) else float(np.exp(t)), ratio_y, years,
                   value)


# -------------------------------------------------------------------- distributed accumulation
def _key(values) -> tuple:
    return tuple(values) if isinstance(values, tuple) else (values,)


def gram_partials(cols: Sequence[str], fold: Sequence[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        q = len(cols)
        for pdf in batches:
            parts = pdf.groupby(list(fold), sort=False) if fold else [((), pdf)]
            for key, part in parts:
                v = part[list(cols)].to_numpy(dtype="float64")
                w = part["_w"].to_numpy(dtype="float64")
                total = sums.setdefault(_key(key), np.zeros(q * q + 2))
                total[: q * q] += (v.T @ (v * w[:, None])).ravel()
                total[-2] += len(w)
                total[-1] += np.log(w).sum()
        yield from _blobs(sums, fold)
    return run


def _node_partials(cols: Sequence[str], fold: Sequence[str], nodes: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            parts = pdf.groupby(list(fold), sort=False) if fold else [((), pdf)]
            for key, part in parts:
                s = part[list(cols)].to_numpy(dtype="float64")
                w = part["_w"].to_numpy(dtype="float64")
                flat = np.append(s.sum(axis=0), w.sum())
                new = np.append(group_terms(s, w, nodes).ravel(), flat)
                old = sums.get(_key(key))
                sums[_key(key)] = new if old is None else old + new
        yield from _blobs(sums, fold)
    return run


def _blobs(sums: dict[tuple, np.ndarray], fold: Sequence[str]) -> Iterator[pd.DataFrame]:
    if sums:
        out = pd.DataFrame(list(sums.keys()), columns=list(fold)) if fold else \
            pd.DataFrame(index=range(len(sums)))
        out["blob"] = [v.tobytes() for v in sums.values()]
        yield out


def _add_blobs(keys: Sequence[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in pdf["blob"])
        out = pdf[list(keys)].iloc[:1].copy()
        out["blob"] = [total.tobytes()]
        return out
    return run


def _schema(df: DataFrame, fold: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([f"`{c}` {kinds[c]}" for c in fold] + ["blob binary"])


def _sum_blobs(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One blob per key; a key has at most one blob per upstream task."""
    return parts.select(*keys, "blob").groupBy(*keys).applyInPandas(
        _add_blobs(keys), _schema(parts, keys))


def _spread(parts: DataFrame) -> DataFrame:
    """Number the partial sums so that they are added up by many tasks before the driver."""
    return parts.withColumn(SPREAD, F.pmod(F.spark_partition_id(), F.lit(SPREAD_OVER)))


@dataclass
class Accumulated:
    """Fold-wise sums of one design, still distributed, and what is needed to read them."""

    cols: list[str]
    fold: list[str]
    nodes: np.ndarray
    grams: DataFrame
    groups: DataFrame       # one row per random-intercept group: the fold, its weighted sums, its weight


def accumulate(rows: DataFrame, cols: Sequence[str], weight: Column, group: Sequence[str],
               fold: Sequence[str] = (), mean_weight: float = 1.0,
               fold_salts: int = SALTS) -> Accumulated:
    """Sufficient statistics of ``rows`` in two passes, neither holding a group in a task.

    The Gram pass streams rows where they lie, or with folds a fold's rows in ``fold_salts`` tasks, so
    that no task holds the matrices of all folds. The group pass sums per group inside the JVM with
    map-side combining, so a hot group is reduced before it is shuffled. A group stays one short
    row: what it adds at the nodes is worked out where it is used.
    """
    cols, fold = list(cols), list(fold)
    nodes = chebyshev_nodes(mean_weight)
    rows = rows.withColumn("_w", weight)
    at = rows.repartition(*fold, F.pmod(F.xxhash64(*group), F.lit(fold_salts))) if fold else rows
    grams = at.select(*fold, "_w", *cols).mapInPandas(
        gram_partials(cols, fold), _schema(rows, fold))
    per_group = rows.groupBy(*dict.fromkeys([*fold, *group])).agg(
        F.sum("_w").alias("_w"), *[F.sum(F.col(c) * F.col("_w")).alias(c) for c in cols])
    per_group = per_group.select(*fold, "_w", *cols)
    grams = _sum_blobs(grams if fold else _spread(grams), fold or [SPREAD])
    return Accumulated(cols, fold, nodes, grams.persist(), per_group.persist())


def _unpack(gram: np.ndarray, terms: np.ndarray, q: int, n_nodes: int):
    body = terms[: -(q + 1)].reshape(n_nodes, q * q + q + 2)
    corrections = np.column_stack([body[:, : q * q], body[:, -1]])
    by = body[:, q * q: q * q + q + 1]
    return gram[: q * q].reshape(q, q), gram[-2], gram[-1], corrections, by, terms[-(q + 1):]


def total_moments(acc: Accumulated, year: str | None = None) -> Moments:
    """Whole-data sums on the driver: a few small matrices per level of ``year``."""
    q, nn = len(acc.cols), len(acc.nodes)

    def read(df: DataFrame) -> dict:
        if year:
            return {r[0]: np.frombuffer(r[1]) for r in _sum_blobs(df, [year]).collect()}
        return {None: sum(np.frombuffer(r["blob"]) for r in df.select("blob").collect())}
    keys = [year] if year else []
    groups = acc.groups.select(*keys, "_w", *acc.cols)
    if year:        # a task sees few years, so it holds few of their sums
        groups = groups.repartition(year, F.pmod(F.hash("_w", *acc.cols), F.lit(SALTS)))
    parts = groups.mapInPandas(_node_partials(acc.cols, keys, nodes=acc.nodes), _schema(acc.groups, keys))
    terms = read(parts if year else _sum_blobs(_spread(parts), [SPREAD]))
    grams = read(acc.grams)
    names = sorted(terms, key=lambda k: (k is None, k))
    parts = [_unpack(grams[k], terms[k], q, nn) for k in names]
    return Moments(sum(p[0] for p in parts), sum(p[1] for p in parts), sum(p[2] for p in parts),
                   sum(p[3] for p in parts), np.stack([p[4] for p in parts]),
                   np.stack([p[5] for p in parts]), names)
