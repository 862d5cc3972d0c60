"""Negative-binomial dispersion: one slope and theta, by Newton steps of one aggregate each."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdcast.operators import checks as C


@dataclass
class NegBinFit:
    beta: float
    theta: float
    iterations: int

    @property
    def residual_sd(self) -> float:
        return math.sqrt(1 / self.theta)


def prepare(rows: DataFrame, count: str = "Count", predictor: str = "totpred",
            sensitivity: str = "Sensitivity") -> DataFrame:
    """Rounded counts, predictor and the weight log(100 / sensitivity). A row that lacks one of them is an error."""
    lacking = rows.filter(F.col(count).isNull() | F.col(predictor).isNull() | F.col(sensitivity).isNull())
    C.require(lacking.select(count, predictor, sensitivity), "a row lacks its count, prediction or sensitivity")
    return rows.select(F.bround(count, 0).alias("y"), F.col(predictor).alias("x"),
                       F.log(F.lit(100.0) / F.col(sensitivity)).alias("w"))


def _asymptotic(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digamma and trigamma of arguments above eight, by their asymptotic series."""
    i1 = 1 / z
    i2 = i1 * i1
    psi = np.log(z) - i1 / 2 - i2 * (1 / 12 - i2 * (1 / 120 - i2 * (1 / 252 - i2 * (
        1 / 240 - i2 / 132))))
    psi1 = i1 + i2 / 2 + i1 * i2 * (1 / 6 - i2 * (1 / 30 - i2 * (1 / 42 - i2 / 30)))
    return psi, psi1


def polygamma01(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digamma and trigamma for x > 0."""
    steps = x[:, None] + np.arange(8)[None, :]
    psi, psi1 = _asymptotic(x + 8)
    return psi - (1 / steps).sum(axis=1), psi1 + (1 / steps ** 2).sum(axis=1)


def _gamma_sums(theta: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        d0, d1 = polygamma01(np.array([theta]))
        for pdf in batches:
            a0, a1 = polygamma01(pdf["y"].to_numpy(dtype="float64") + theta)
            w = pdf["w"].to_numpy(dtype="float64")
            yield pd.DataFrame({"st": [float(w @ (a0 - d0))], "ht": [float(w @ (a1 - d1))]})
    return run


def fit_dispersion(data: DataFrame, tol: float = 1e-8, max_iter: int = 60) -> NegBinFit:
    """Maximum likelihood of y ~ NB(exp(beta x), theta) with weights (y, x, w columns).

    The two parameters are orthogonal, so both take their own Newton step from the same
    pass. The gamma-function terms depend on the count alone and come from the table of
    distinct counts; everything else is one aggregate inside the JVM.
    """
    data = data.persist()
    y, x, w = F.col("y"), F.col("x"), F.col("w")
    start = data.agg(F.min("w").alias("wmin"), F.sum("w").alias("sw"),
                     (F.sum(w * y) / F.sum("w")).alias("my"),
                     (F.sum(w * x) / F.sum("w")).alias("mx")).first()
    if start["sw"] is None:
        raise ValueError("no rows to estimate the dispersion from")
    if start["wmin"] < 0:
        raise ValueError("a sensitivity above 100 would give a negative weight")
    counts = data.groupBy("y").agg(F.sum("w").alias("w")).persist()
    beta = math.log(max(start["my"], 1e-3)) / start["mx"] if start["mx"] else 0.0
    log_theta = 0.0
    for i in range(1, max_iter + 1):
        theta = math.exp(log_theta)
        th = F.lit(theta)
        mu = F.exp(x * F.lit(beta))
        both = th + mu
        ratio = (y + th) / both
        sums = data.agg(
            F.sum(w * x * (y - mu) * th / both).alias("sb"),
            F.sum(w * x * x * mu * th / both).alias("ib"),
            F.sum(w * (F.lit(1 + log_theta) - F.log(both) - ratio)).alias("st"),
            F.sum(w * (F.lit(1 / theta) - (F.lit(2.0) - ratio) / both)).alias("ht"))
        gammas = counts.mapInPandas(_gamma_sums(theta), "st double, ht double").agg(
            F.lit(0.0).alias("sb"), F.lit(0.0).alias("ib"), F.sum("st").alias("st"),
            F.sum("ht").alias("ht"))
        parts = sums.unionByName(gammas).collect()
        s = {k: sum(r[k] for r in parts) for k in ("sb", "ib", "st", "ht")}
        score, hess = s["st"], s["ht"]
        step_b = max(-0.5, min(0.5, s["sb"] / s["ib"]))
        # Newton in log(theta); a score-signed step where the surface is not concave
        slope, curve = theta * score, -(theta * theta * hess + theta * score)
        step_t = slope / curve if curve > 0 else math.copysign(0.5, slope)
        step_t = max(-1.0, min(1.0, step_t))
        beta, log_theta = beta + step_b, log_theta + step_t
        if abs(step_b) < tol * max(abs(beta), 1) and abs(step_t) < tol:
            break
    data.unpersist()
    counts.unpersist()
    return NegBinFit(beta, math.exp(log_theta), i)
