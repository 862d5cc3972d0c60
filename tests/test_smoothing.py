"""Level-and-slope smoothing against the dense Gaussian solution, in one block and in several."""

import datetime

import numpy as np
import pandas as pd
import pytest

from herdcast.operators import smoothing as S
from herdcast.operators import weather as wx


def dense(y, r, q):
    """Conditional means of the levels, and -2 log likelihood, from full matrices; the start enters as two regression terms."""
    n = len(y)
    cov, blocks = np.zeros((2, 2)), np.zeros((n, n, 2, 2))
    for t in range(n):
        cov = S.STEP @ cov @ S.STEP.T + np.diag(q)
        step = cov
        blocks[t, t] = cov
        for s in range(t + 1, n):
            step = S.STEP @ step
            blocks[s, t], blocks[t, s] = step, step.T
    level, X, seen = blocks[:, :, 0, 0], np.column_stack([np.ones(n), np.arange(1, n + 1)]), ~np.isnan(y)
    V = level[np.ix_(seen, seen)] + r * np.eye(seen.sum())
    solved = np.linalg.solve(V, np.column_stack([X[seen], y[seen]]))
    inner = np.eye(2) / S.DIFFUSE + X[seen].T @ solved[:, :2]
    first = np.linalg.solve(inner, X[seen].T @ solved[:, 2])
    free = max(seen.sum() - 2, 1)
    quad = y[seen] @ solved[:, 2] - first @ (X[seen].T @ solved[:, 2])
    logdet = np.linalg.slogdet(V)[1] + 2 * np.log(S.DIFFUSE) + np.linalg.slogdet(inner)[1]
    means = X @ first + level[:, seen] @ (solved[:, 2] - solved[:, :2] @ first)
    return np.where(seen, y, means), logdet + free * np.log(quad / free)


def series(n=200, seed=0):
    rng = np.random.default_rng(seed)
    slope = np.cumsum(rng.normal(0, 0.05, n))
    y = np.cumsum(slope + rng.normal(0, 0.4, n)) + rng.normal(0, 1, n)
    y = y - y.mean()
    y[60:75], y[120], y[150:153] = np.nan, np.nan, np.nan
    return y


@pytest.mark.parametrize("cuts", [[], [50, 100, 150], [1, 66, 199]])
@pytest.mark.parametrize("r, q", [(1.0, (0.2, 0.003)), (1.0, (1e-5, 1e-9)), (0.01, (1.0, 0.0))])
def test_blocks_equal_the_dense_solution(cuts, r, q):
    y = series()
    want, value = dense(y, r, q)
    parts = np.split(y[:, None], cuts)
    rr, qq = np.array([r]), np.array([q])
    elements = [S.Element.unpack(S.filter_block(p, rr, qq).pack()) for p in parts]
    got = np.concatenate([S.smooth_block(p, rr, qq, e) for p, e in zip(parts, S.ends(elements))])[:, 0]
    np.testing.assert_allclose(got, want, atol=1e-6)
    assert S.profile(elements)[0] == pytest.approx(value, abs=1e-5)


def test_search_ends_at_the_highest_likelihood():
    y = series(seed=3)
    best = None
    for round_ in range(S.ROUNDS):
        tried = S.candidates(best, round_)
        values = S.profile([S.filter_block(np.repeat(y[:, None], len(tried), axis=1), np.ones(len(tried)), np.exp(tried))])
        best = tried[values.argmin()]
    for d in ((0.3, 0), (-0.3, 0), (0, 0.3), (0, -0.3)):
        assert values.min() <= dense(y, 1.0, tuple(np.exp(best + d)))[1] + 1e-3      # the search stops on a grid


def test_table_in_blocks(spark):
    day = datetime.date(2001, 1, 1)
    rows = [(s, day + datetime.timedelta(t), None if np.isnan(v) else float(v) + 10, None, "x")
            for s, seed in (("a", 0), ("b", 1)) for t, v in enumerate(series(seed=seed))]
    df = spark.createDataFrame(rows, "Site string, Date date, Temp_avg double, Temp_low double, Note string").repartition(5)
    names = ("Temp_avg", "Temp_low")
    whole = wx.impute_gaps(df, ("Site",), names).toPandas().sort_values(["Site", "Date"])
    parts = wx.impute_gaps(df, ("Site",), names, block_days=37).toPandas().sort_values(["Site", "Date"])
    np.testing.assert_allclose(parts["Temp_avg"], whole["Temp_avg"], atol=1e-6)
    assert len(whole) == 400 and whole["Temp_avg"].notna().all() and whole["Temp_low"].isna().all() and (whole["Note"] == "x").all()
    one = wx.impute_gaps(df.where("Site = 'a'").drop("Site"), (), ("Temp_avg",), variances=(1.0, 0.2, 0.003), block_days=50).toPandas().sort_values("Date")
    raw = pd.Series([r[2] for r in rows[:200]], dtype=float)
    want = dense((raw - raw.mean()).to_numpy(), 1.0, (0.2, 0.003))[0] + raw.mean()
    np.testing.assert_allclose(one["Temp_avg"], want, atol=1e-6)
    assert wx.impute_gaps(df.where("false"), ("Site",), names).count() == 0
