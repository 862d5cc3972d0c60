"""Chain of common, location and individual models, fitted in turn until they agree.

All of them are linear in one set of columns, so the cross-products of those columns and
their per-animal sums are accumulated once; every round of the loop is then arithmetic on
matrices of about thirty columns, with no pass over the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdcast.operators import features as ft
from herdcast.operators import mixed as mx
from herdcast.operators.group_model import level_counts
from herdcast.schema import AGE_LEVELS, DOSE_CAT_LEVELS, SEX_LEVELS, ModelSpec

TAGS = (4, 8, 12)
DOSE_FLAGS = {8: {4: "dose5_12wk", 8: "dose9_16wk", 12: "dose13_20wk"},
              12: {4: "dose5_16wk", 8: "dose9_20wk", 12: "dose13_24wk"}}


@dataclass
class Backfit:
    common: dict[str, float]
    residual: dict[int, dict[str, float]]
    individual: dict[int, dict[str, float]]        # 0 (last year only), 4, 8, 12
    centering: dict[str, float]
    levels: dict[str, list[str]]
    animal_ratio: float
    converged: bool
    iterations: int
    convergence: list[tuple[str, float, float]]    # name, new, last
    total: Column                                  # total prediction of a prepared row


def _ordered(levels: list[str], declared: tuple[str, ...]) -> list[str]:
    """Most frequent level first, the others in declared order."""
    return levels[:1] + [v for v in declared if v in levels[1:]]


def prepare_rows(rows: DataFrame, spec: ModelSpec = ModelSpec()) -> DataFrame:
    """Residuals of the location history, and removal of counts taken after a treatment."""
    out = rows.withColumns({
        f"residual_location{k}": F.col(f"loc_pred_{k}wk") - F.col(f"loc_obs_{k}wk") for k in TAGS})
    if spec.txrm and spec.txtime:
        flags = DOSE_FLAGS[spec.txtime]
        gone = {f"fec{k}wk": F.when(~F.col(flags[k]), F.col(f"fec{k}wk")) for k in TAGS}
        out = out.withColumns(gone)
        # a row whose own tier lost its count has no individual offset and leaves the fits
        out = out.filter(
            " AND ".join(f"NOT (Tier = {k} AND fec{k}wk IS NULL)" for k in TAGS))
    return out


class Columns:
    """The extended columns, each zero where its model does not see the row."""

    def __init__(self, spec: ModelSpec, levels: dict[str, list[str]], centre: dict[str, float]):
        self.spec, self.defs = spec, {}
        self.common = ["(Intercept)"]
        self.defs["(Intercept)"] = F.lit(1.0)
        for factor in ("Sex", "AgeCat", "LastDoseCat"):
            for level in levels[factor][1:]:
                self._add(self.common, f"{factor}{level}", (F.col(factor) == level).cast("double"))
        self.defs["Obs"] = F.col("Obs")
        self.defs["Group"] = F.col("GroupPredictionNoTx")
        self.location: dict[int, list[str]] = {}
        self.located: dict[int, list[str]] = {}
        self.individual: dict[int, list[str]] = {}
        self.tiered: dict[int, list[str]] = {}
        self._locations(centre)
        self._individuals(centre)

    def _add(self, group: list[str], name: str, col: Column) -> None:
        self.defs[name] = col
        group.append(name)

    def _locations(self, centre: dict[str, float]) -> None:
        n = {k: F.coalesce(F.col(f"loc_n_{k}wk"), F.lit(0)) >= 5 for k in TAGS}
        where = {4: n[4], 8: n[8] & ~n[4], 12: n[12] & ~n[8] & ~n[4]}
        for k in TAGS:
            r = F.col(f"residual_location{k}") - F.lit(centre.get(f"res{k}mean"))
            parts = {f"residual_location{k}": r}
            if self.spec.resid_doy_interaction:
                parts |= {f"residual_location{k}:{d}": r * F.col(d) for d in ("cdoy", "sdoy")}
            self.location[k], self.located[k] = [], []
            for name, c in parts.items():
                self._add(self.location[k], name, F.coalesce(c, F.lit(0.0)))
                if self.spec.use_location_offsets:
                    self._add(self.located[k], f"at:{name}",
                              F.when(where[k], F.coalesce(c, F.lit(0.0))).otherwise(F.lit(0.0)))

    def _individuals(self, centre: dict[str, float]) -> None:
        last = F.col("lastYearMeanFEC") - F.lit(centre.get("feclastyearmean"))
        for k in (0, *TAGS):
            parts: dict[str, Column] = {}
            value = last if k == 0 else F.col(f"fec{k}wk") - F.lit(centre.get(f"fec{k}wkmean"))
            seen = value.isNotNull()
            if k and self.spec.lastyear:
                seen = seen & last.isNotNull()
            if self.spec.individual_intercept:
                parts["(Intercept)"] = F.lit(1.0)
            if k and self.spec.txtime and not self.spec.txrm:
                flag = F.col(DOSE_FLAGS[self.spec.txtime][k])
                for label, hit in (("FALSE", ~flag), ("TRUE", flag)):
                    parts[f"fec{k}wk:{DOSE_FLAGS[self.spec.txtime][k]}{label}"] = \
                        F.when(hit, value).otherwise(F.lit(0.0))
            elif k:
                parts[f"fec{k}wk"] = value
            if k == 0 or self.spec.lastyear:
                parts["lastYearMeanFEC"] = last
            self.individual[k], self.tiered[k] = [], []
            for name, c in parts.items():
                self._add(self.individual[k], f"ind{k}:{name}",
                          F.when(seen, c).otherwise(F.lit(0.0)))
                self._add(self.tiered[k], f"tier{k}:{name}",
                          F.when(F.col("Tier") == k, c).otherwise(F.lit(0.0)))


def _least_squares(gram: np.ndarray, reg: list[int], response: np.ndarray) -> np.ndarray:
    """Coefficients (NaN where dependent) of ``response`` on columns ``reg``."""
    out = np.full(len(reg), np.nan)
    xx = gram[np.ix_(reg, reg)]
    keep = mx.independent_columns(xx)
    if keep:
        xy = gram[reg] @ response
        out[keep] = np.linalg.solve(xx[np.ix_(keep, keep)], xy[keep])
    return out


# The no-intercept models of one pass, by name.
SLOPE_MODELS = {"residual_4": ("residual_location4",), "residual_8": ("residual_location8",),
                "residual_12": ("residual_location12",), "ind_0": ("lastYearMeanFEC",),
                "ind_4": ("fec4wk", "lastYearMeanFEC"), "ind_8": ("fec8wk", "lastYearMeanFEC"),
                "ind_12": ("fec12wk", "lastYearMeanFEC")}


def fit_offset_slopes(rows: DataFrame, models: dict[str, tuple[str, ...]], response: str = "Obs",
                      offset: Column | None = None) -> DataFrame:
    """No-intercept least squares with one or two regressors, all models in one aggregate.

    Each model uses the rows where its regressors are present; the result is a lazy
    table (model, term, estimate).
    """
    y = F.col(response) - (offset if offset is not None else F.lit(0.0))

    def total(seen: Column, value: Column) -> Column:
        return F.sum(F.when(seen, value))
    out = []
    for name, terms in models.items():
        xs = [F.col(t) for t in terms]
        seen = y.isNotNull()
        for x in xs:
            seen = seen & x.isNotNull()
        if len(xs) == 1:
            est = [total(seen, xs[0] * y) / total(seen, xs[0] * xs[0])]
        else:
            a, b, c = (total(seen, xs[i] * xs[j]) for i, j in ((0, 0), (0, 1), (1, 1)))
            u, v = total(seen, xs[0] * y), total(seen, xs[1] * y)
            det = a * c - b * b
            est = [(c * u - b * v) / det, (a * v - b * u) / det]
        out += [F.struct(F.lit(name).alias("model"), F.lit(t).alias("term"), e.alias("estimate"))
                for t, e in zip(terms, est)]
    return rows.agg(F.array(*out).alias("m")).select(F.inline("m"))


def fit_backfit(rows: DataFrame, spec: ModelSpec = ModelSpec(), every: DataFrame | None = None) -> Backfit:
    """``rows`` (persisted, from ``prepare_rows``) to converged coefficients.

    Reference levels are the most frequent among ``every`` individual row, where given.
    """
    every = rows if every is None else every
    centre = {k: v for k, v in ft.center_means(rows).first().asDict().items() if v is not None}
    levels = {"Sex": _ordered(level_counts(every, "Sex", SEX_LEVELS), SEX_LEVELS),
              "AgeCat": _ordered(level_counts(every, "AgeCat", AGE_LEVELS), AGE_LEVELS)}
    seen = level_counts(rows, "LastDoseCat")
    levels["LastDoseCat"] = [v for v in DOSE_CAT_LEVELS if v in seen or v == ">12"]
    return fit_with_levels(rows, spec, levels, centre)


def fit_with_levels(rows: DataFrame, spec: ModelSpec, levels: dict[str, list[str]],
                    centre: dict[str, float]) -> Backfit:
    cols = Columns(spec, levels, centre)
    names = list(cols.defs)
    at = {n: i for i, n in enumerate(names)}
    ext = rows.select("AnimalID", *[c.alias(f"v{i}") for i, c in enumerate(cols.defs.values())])
    size = rows.agg(F.count(F.lit(1)).alias("n"),
                    F.count_distinct("AnimalID").alias("a")).first()
    if not size["n"]:
        raise ValueError("no individual rows are complete enough to be modelled")
    acc = mx.accumulate(ext, [f"v{i}" for i in range(len(names))], F.lit(1.0), ["AnimalID"],
                        mean_weight=size["n"] / size["a"])
    total = mx.total_moments(acc)
    gram, q = total.gram, len(names)
    xs = [at[n] for n in cols.common]

    def unit(name: str) -> np.ndarray:
        v = np.zeros(q)
        v[at[name]] = 1.0
        return v

    loc, ind = np.zeros(q), np.zeros(q)
    new: dict[str, float] = {}
    recent, ratio, converged, it = [1.0, 1.0, 1.0], 0.0, False, 0
    last: dict[str, float] = {}
    for it in range(1, spec.maxiters + 1):
        last = new
        # common model: fixed effects only are passed on
        response = unit("Obs") - unit("Group") - loc - ind
        beta, ratio = _common(total, acc.nodes, xs, response, spec.common_re)
        new = dict(zip(cols.common, beta))
        common = unit("Group")
        common[xs] += np.nan_to_num(beta)
        # location models see the data less the common and individual parts
        residual, loc_next = {}, np.zeros(q)
        for k in TAGS:
            reg = [at[n] for n in cols.location[k]]
            b = _least_squares(gram, reg, unit("Obs") - common - ind)
            residual[k] = dict(zip(cols.location[k], b))
            for n, v in zip(cols.located[k], b):
                loc_next[at[n]] = np.nan_to_num(v)
            new |= residual[k]
        loc = loc_next
        # individual models, each passed on only for the rows of its tier
        individual, ind_next = {}, np.zeros(q)
        for k in (0, *TAGS):
            reg = [at[n] for n in cols.individual[k]]
            b = _least_squares(gram, reg, unit("Obs") - common - loc)
            individual[k] = {n.split(":", 1)[1]: v for n, v in zip(cols.individual[k], b)}
            for n, v in zip(cols.tiered[k], b):
                ind_next[at[n]] = np.nan_to_num(v)
            new |= dict(zip(cols.individual[k], b))
        ind = ind_next
        if last:
            a, b = np.array(list(new.values())), np.array(list(last.values()))
            with np.errstate(divide="ignore", invalid="ignore"):
                diff = np.abs((a - b) / ((a + b) / 2))
            recent = [*recent[1:], float(np.nanmax(diff))]
            if all(d < spec.tol for d in recent):
                converged = True
                break
    weights = common + loc + ind
    prediction = F.lit(0.0)
    for name, c in zip(names, weights):
        if c:
            prediction = prediction + cols.defs[name] * F.lit(float(c))
    table = [(n, float(v), float(last.get(n, np.nan))) for n, v in new.items()]
    return Backfit({n: float(new[n]) for n in cols.common}, residual, individual, centre, levels,
                   ratio, converged, it, table, prediction)


def _common(total: mx.Moments, nodes: np.ndarray, xs: list[int], response: np.ndarray,
            use_group: bool) -> tuple[np.ndarray, float]:
    """Project the accumulated sums onto [X, response] and fit."""
    q, p = len(response), len(xs)
    proj = np.zeros((q, p + 1))
    proj[xs, range(p)] = 1.0
    proj[:, p] = response
    c = total.terms[:, :-1].reshape(-1, q, q)
    small = np.matmul(proj.T, np.matmul(c, proj))
    terms = np.column_stack([small.reshape(len(c), -1), total.terms[:, -1]])
    flat = np.append(total.flat_by_year[0][:-1] @ proj, total.flat_by_year[0][-1])
    by = np.concatenate([total.by_year[0][:, :-1] @ proj, total.by_year[0][:, -1:]], axis=1)
    m = mx.Moments(proj.T @ total.gram @ proj, total.n, total.log_w, terms, by[None], flat[None],
                   [None])
    fit = mx.Problem(m, p, nodes, use_group, False).optimum()
    return fit.beta, fit.ratio_group
