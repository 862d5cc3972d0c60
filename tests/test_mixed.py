"""REML from sufficient statistics against dense matrices, and the backfit loop against one."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from herdcast.operators import backfit as bf
from herdcast.operators import group_model as gm
from herdcast.operators import mixed as mx
from herdcast.operators import negbin as nb
from herdcast.schema import ModelSpec, Options


def dense(X, y, w, groups, years, tl, ty):
    """REML criterion, coefficients and residual variance from the full covariance."""
    V = np.diag(1 / w)
    V += tl * (groups[:, None] == groups[None, :])
    V += ty * (years[:, None] == years[None, :])
    Vi = np.linalg.inv(V)
    xx = X.T @ Vi @ X
    beta = np.linalg.solve(xx, X.T @ Vi @ y)
    r = y - X @ beta
    s2 = r @ Vi @ r / (len(y) - X.shape[1])
    crit = (np.linalg.slogdet(V)[1] + np.linalg.slogdet(xx)[1]
            + (len(y) - X.shape[1]) * np.log(s2))
    return crit, beta, s2, ty * (Vi @ r)


def frame(seed=0, farms=3, locs=3, years=5, weeks=12, sl=0.5, sy=0.4):
    rng = np.random.default_rng(seed)
    rows = []
    ye = rng.normal(0, sy, years)
    for f in range(farms):
        for l in range(locs):
            for y in range(years):
                le = rng.normal(0, sl)
                for k in range(weeks):
                    x = rng.normal(), rng.uniform(5, 20)
                    w = float(rng.integers(8, 30))
                    v = 3 + 0.5 * (f == 1) + 0.7 * x[0] - 0.05 * x[1] + le + ye[y] \
                        + rng.normal(0, 1) / np.sqrt(w)
                    rows.append((f"F{f}", 2000 + y, f"F{f}_L{l}_{2000 + y}", k, w, *x, v))
    return pd.DataFrame(rows, columns=["Farm", "Year", "LocationYear", "Week", "TotalFEC", "a",
                                       "b", "meanLogFEC"])


SPEC = ModelSpec(terms=("factor(Farm)", "a", "b", "b^2/10"))


def design(pdf, drop_farm=None):
    cols = [np.ones(len(pdf))]
    top = sorted(pdf["Farm"].unique())[0]
    cols += [(pdf["Farm"] == f).astype(float) for f in sorted(pdf["Farm"].unique()) if f != top]
    return np.column_stack([*cols, pdf["a"], pdf["b"], pdf["b"] ** 2 / 10])


@pytest.fixture(scope="module")
def fitted(spark):
    pdf = frame()
    df = spark.createDataFrame(pdf).withColumns({
        "Hygiene": F.lit("None"), "TotalAnimals": F.lit(30)})
    return pdf, gm.fit_group_model(df, SPEC, Options())


def check(pdf, beta, sigma2, tl, ty):
    pdf = pdf[pdf["TotalFEC"] >= 10]
    args = (design(pdf), pdf["meanLogFEC"].to_numpy(), pdf["TotalFEC"].to_numpy(),
            pdf["LocationYear"].to_numpy(), pdf["Year"].to_numpy())
    crit, want, s2, dev = dense(*args, tl, ty)
    np.testing.assert_allclose(beta, want, rtol=1e-6, atol=1e-8)
    assert sigma2 == pytest.approx(s2, rel=1e-6)
    for fl, fy in ((1.02, 1), (0.98, 1), (1, 1.02), (1, 0.98)):      # a minimum in both ratios
        assert crit <= dense(*args, tl * fl, ty * fy)[0] + 1e-9
    return dev


def test_group_fit_matches_dense(fitted):
    pdf, g = fitted
    f = g.fit
    dev = check(pdf, list(g.coefficients.values()), f.sigma2, f.ratio_group, f.ratio_year)
    used = pdf[pdf["TotalFEC"] >= 10]
    for y, e in f.year_effect.items():      # predicted year effect: t times sum of V^-1 r
        assert e == pytest.approx(dev[(used["Year"] == y).to_numpy()].sum(), rel=1e-5, abs=1e-7)


def test_every_exclusion_matches_dense(fitted):
    pdf, g = fitted
    folds = g.folds.collect()
    assert len(folds) == 15
    long = gm.fold_coefficients(g).toPandas().sort_values("ord")
    for r in folds:
        rest = pdf[(pdf["Farm"] != r["Farm"]) | (pdf["Year"] != r["Year"])]
        own = long[(long["Farm"] == r["Farm"]) & (long["Year"] == r["Year"])]
        assert own["term"].tolist() == g.names
        check(rest, own["estimate"].to_numpy(), r["sigma2"], r["ratio_group"], r["ratio_year"])
        effect = own.set_index("term")["estimate"].get(f"Farm{r['Farm']}", 0.0)
        assert r["farm_effect"] == pytest.approx(effect, abs=1e-9)


def test_reference_farm_left_out_altogether(spark):
    """Without its only year the reference farm has no rows: the last level takes the intercept."""
    pdf = frame()
    pdf = pdf[(pdf["Farm"] != "F0") | (pdf["Year"] == 2001)]
    pdf = pd.concat([pdf, *[pdf[pdf["Farm"] == "F0"].assign(LocationYear=f"F0_M{k}_2001") for k in range(12)]])
    df = spark.createDataFrame(pdf).withColumns({"Hygiene": F.lit("None"), "TotalAnimals": F.lit(9)})
    g = gm.fit_group_model(df, SPEC, Options())
    assert g.levels["Farm"][0] == "F0"
    long = gm.fold_coefficients(g).where("Farm = 'F0' AND Year = 2001").toPandas().set_index("term")["estimate"]
    r = g.folds.where("Farm = 'F0' AND Year = 2001").first()
    rest = pdf[pdf["Farm"] != "F0"]
    X = np.column_stack([np.ones(len(rest)), rest["Farm"] == "F1", rest["a"], rest["b"], rest["b"] ** 2 / 10]).astype(float)
    keep = rest["TotalFEC"] >= 10
    want = dense(X[keep], *(rest[c][keep].to_numpy() for c in ("meanLogFEC", "TotalFEC", "LocationYear", "Year")), r.ratio_group, r.ratio_year)[1]
    assert np.isnan(long["FarmF2"]) and r.farm_effect is None
    np.testing.assert_allclose(long[["(Intercept)", "FarmF1", "a", "b", "I(b^2/10)"]], want, rtol=1e-6, atol=1e-8)


def test_single_farm_year_drops_its_dummy(spark):
    pdf = frame(farms=2)
    pdf = pdf[(pdf["Farm"] == "F0") | (pdf["Year"] == 2000)]
    df = spark.createDataFrame(pdf).withColumns({"Hygiene": F.lit("None"), "TotalAnimals": F.lit(9)})
    g = gm.fit_group_model(df, SPEC, Options())
    fold = {(r["Farm"], r["Year"]): r["estimate"] for r in gm.fold_coefficients(g).where("term = 'FarmF1'").collect()}
    assert fold[("F1", 2000)] is None
    assert fold[("F0", 2001)] is not None


def test_singular_fit_gives_zero_ratio(spark):
    pdf = frame(seed=3, sl=0.0, sy=0.0)
    df = spark.createDataFrame(pdf).withColumns({"Hygiene": F.lit("None"), "TotalAnimals": F.lit(9)})
    f = gm.fit_group_model(df, SPEC, Options()).fit
    assert f.ratio_group < 0.01 and f.ratio_year < 0.01
    pdf = pdf[pdf["TotalFEC"] >= 10]
    args = (design(pdf), pdf["meanLogFEC"].to_numpy(), pdf["TotalFEC"].to_numpy(),
            pdf["LocationYear"].to_numpy(), pdf["Year"].to_numpy())
    assert dense(*args, f.ratio_group, f.ratio_year)[0] <= dense(*args, 0, 0)[0] + 1e-8


def test_hot_group_does_not_change_the_sums(spark):
    """One group holding most rows gives the same moments as numpy."""
    rng = np.random.default_rng(5)
    g = np.where(rng.random(5000) < 0.6, 0, rng.integers(1, 50, 5000))
    v = rng.normal(size=(5000, 3))
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": v[:, 0], "y": v[:, 1], "z": v[:, 2]}))
    acc = mx.accumulate(df, ["x", "y", "z"], F.lit(2.0), ["g"], mean_weight=200)
    m = mx.total_moments(acc)
    np.testing.assert_allclose(m.gram, 2 * v.T @ v, rtol=1e-10)
    s = np.array([2 * v[g == k].sum(axis=0) for k in np.unique(g)])
    w = np.array([2.0 * (g == k).sum() for k in np.unique(g)])
    want = mx.group_terms(s, w, acc.nodes)
    np.testing.assert_allclose(m.terms[:, :9], want[:, :9], rtol=1e-9, atol=1e-9)


def test_interpolation_is_exact_between_nodes():
    rng = np.random.default_rng(2)
    s, w = rng.normal(size=(40, 3)), rng.uniform(5, 3000, 40)
    nodes = mx.chebyshev_nodes(w.mean())
    values = mx.group_terms(s, w, nodes)
    t = np.linspace(nodes[-1], nodes[0], 57)
    got = mx.interpolation_weights(nodes, t) @ values
    np.testing.assert_allclose(got, mx.group_terms(s, w, t), rtol=1e-6, atol=1e-7)


# ------------------------------------------------------------------------------ backfit
def individual(seed=4, animals=60, per=14):
    rng = np.random.default_rng(seed)
    out = []
    for a in range(animals):
        sex, age = rng.choice(["DKF", "DKM", "MUPY"]), rng.choice(["Age_0-5", "Age_6-10"])
        ae = rng.normal(0, 0.5)
        for k in range(per):
            gp, ly = rng.normal(5, .5), rng.normal(5, 1)
            f4, f8, f12 = (rng.normal(5, 1) if rng.random() < p else None for p in (.5, .6, .7))
            r4, r8, r12 = (rng.normal(0, .3) if rng.random() < .8 else None for _ in range(3))
            dose = rng.choice([">12", "1-4", "5-8", "9-12"], p=[.7, .1, .1, .1])
            near = f4 if f4 is not None else f8 if f8 is not None else f12
            obs = gp + ae + .3 * (sex == "DKM") + .2 * ((near or 5) - 5) + .3 * (ly - 5) \
                - .4 * (r4 or 0) + rng.normal(0, .8)
            tier = 4 if f4 is not None else 8 if f8 is not None else 12 if f12 is not None else 0
            out.append((f"A{a}", sex, age, dose, obs, gp, ly, f4, f8, f12, r4, r8, r12, tier,
                        int(rng.integers(0, 12)), int(rng.integers(0, 12)),
                        int(rng.integers(0, 12)), bool(rng.random() < .4)))
    return pd.DataFrame(out, columns=[
        "AnimalID", "Sex", "AgeCat", "LastDoseCat", "Obs", "GroupPredictionNoTx",
        "lastYearMeanFEC", "fec4wk", "fec8wk", "fec12wk", "residual_location4",
        "residual_location8", "residual_location12", "Tier", "loc_n_4wk", "loc_n_8wk",
        "loc_n_12wk", "flag"])


def dense_backfit(pdf, levels, offsets, rounds=60):
    """The loop written out on the rows, with a dense random-intercept fit."""
    p = pdf.copy()
    for c in ("lastYearMeanFEC", "fec4wk", "fec8wk", "fec12wk", "residual_location4",
              "residual_location8", "residual_location12"):
        p[c] = p[c].astype(float) - p[c].astype(float).mean()
    X = np.column_stack([np.ones(len(p))] + [
        (p[f] == v).astype(float) for f in ("Sex", "AgeCat", "LastDoseCat") for v in levels[f][1:]])
    y, gp = p["Obs"].to_numpy(), p["GroupPredictionNoTx"].to_numpy()
    codes = pd.factorize(p["AnimalID"])[0]
    loc, ind = np.zeros(len(p)), np.zeros(len(p))
    n = {k: p[f"loc_n_{k}wk"].to_numpy() >= 5 for k in (4, 8, 12)}
    where = {4: n[4], 8: n[8] & ~n[4], 12: n[12] & ~n[8] & ~n[4]}
    lam, Q = np.linalg.eigh((codes[:, None] == codes[None, :]).astype(float))
    QX = Q.T @ X

    def reml(response, t):
        d, r = 1 / (1 + t * lam), Q.T @ response
        xx = QX.T @ (QX * d[:, None])
        beta = np.linalg.solve(xx, QX.T @ (d * r))
        s2 = (d * (r - QX @ beta) ** 2).sum() / (len(y) - X.shape[1])
        return (-np.log(d).sum() + np.linalg.slogdet(xx)[1]
                + (len(y) - X.shape[1]) * np.log(s2)), beta
    for _ in range(rounds):
        grid = np.exp(np.linspace(-8, 3, 34))
        for _z in range(6):
            i = int(np.argmin([reml(y - gp - loc - ind, t)[0] for t in grid]))
            grid = np.exp(np.linspace(np.log(grid[max(i - 1, 0)]),
                                      np.log(grid[min(i + 1, len(grid) - 1)]), 9))
        beta = reml(y - gp - loc - ind, grid[4])[1]
        common = gp + X @ beta
        res, ind_b, new_loc, new_ind = {}, {}, np.zeros(len(p)), np.zeros(len(p))
        for k in (4, 8, 12):
            r = p[f"residual_location{k}"].to_numpy()
            ok = ~np.isnan(r)
            res[k] = (r[ok] @ (y - common - ind)[ok]) / (r[ok] @ r[ok])
            if offsets:
                new_loc[where[k]] = np.nan_to_num(r)[where[k]] * res[k]
        loc = new_loc
        for k in (0, 4, 8, 12):
            cols = ["lastYearMeanFEC"] if k == 0 else [f"fec{k}wk", "lastYearMeanFEC"]
            Z = p[cols].to_numpy()
            ok = ~np.isnan(Z).any(axis=1)
            ind_b[k] = np.linalg.lstsq(Z[ok], (y - common - loc)[ok], rcond=None)[0]
            tier = (p["Tier"] == k).to_numpy()
            new_ind[tier] = Z[tier] @ ind_b[k]
        ind = new_ind
    return beta, res, ind_b, common + loc + ind


@pytest.mark.parametrize("offsets", [False, True])
def test_backfit_matches_row_by_row_loop(spark, offsets):
    pdf = individual(animals=25)
    df = spark.createDataFrame(pdf).repartition(8).persist()
    fit = bf.fit_backfit(df, ModelSpec(use_location_offsets=offsets, tol=1e-9))
    assert fit.converged
    beta, res, ind, total = dense_backfit(pdf, fit.levels, offsets, rounds=12)
    np.testing.assert_allclose(list(fit.common.values()), beta, atol=2e-4)
    for k in (4, 8, 12):
        assert list(fit.residual[k].values())[0] == pytest.approx(res[k], abs=2e-4)
    for k in (0, 4, 8, 12):
        np.testing.assert_allclose(list(fit.individual[k].values()), ind[k], atol=2e-4)
    got = df.select("AnimalID", "Obs", fit.total.alias("t")).toPandas().sort_values("Obs")
    np.testing.assert_allclose(got["t"].to_numpy(), total[np.argsort(pdf["Obs"].to_numpy())],
                               atol=1e-3)


def test_backfit_switches(spark):
    pdf = individual()
    for c in ("dose5_12wk", "dose9_16wk", "dose13_20wk"):
        pdf[c] = pdf["flag"]
    pdf["cdoy"], pdf["sdoy"] = 0.3, np.linspace(-1, 1, len(pdf))
    df = spark.createDataFrame(pdf).persist()
    plain = bf.fit_backfit(df, ModelSpec(common_re=False))
    assert plain.animal_ratio == 0
    split = bf.fit_backfit(df, ModelSpec(txtime=8))
    assert set(split.individual[4]) == {"fec4wk:dose5_12wkFALSE", "fec4wk:dose5_12wkTRUE",
                                        "lastYearMeanFEC"}
    doy = bf.fit_backfit(df, ModelSpec(resid_doy_interaction=True))
    assert set(doy.residual[8]) == {"residual_location8", "residual_location8:cdoy",
                                    "residual_location8:sdoy"}
    free = bf.fit_backfit(df, ModelSpec(individual_intercept=True))
    assert "(Intercept)" in free.individual[12]


# ---------------------------------------------------------------------------- dispersion
def test_gamma_derivatives():
    psi, psi1 = nb.polygamma01(np.array([1.0, 0.5, 10.0]))
    np.testing.assert_allclose(psi, [-0.5772156649015329, -1.9635100260214235,
                                     2.251752589066721], rtol=1e-12)
    np.testing.assert_allclose(psi1, [np.pi ** 2 / 6, np.pi ** 2 / 2, 0.10516633568168575],
                               rtol=1e-11)


def test_dispersion_is_the_maximum(spark):
    rng = np.random.default_rng(6)
    x = rng.uniform(1, 6, 4000)
    mu, theta = np.exp(0.4 * x), 1.7
    y = rng.negative_binomial(theta, theta / (theta + mu)).astype(float)
    w = np.where(rng.random(4000) < .5, np.log(2), np.log(4))
    df = spark.createDataFrame(pd.DataFrame({"y": y, "x": x, "w": w}))
    f = nb.fit_dispersion(df)

    from math import lgamma
    lg = np.vectorize(lgamma)

    def loglik(b, t):
        m = np.exp(b * x)
        return (w * (lg(t + y) - lgamma(t) + t * np.log(t / (t + m)) + y * np.log(m / (t + m)))).sum()
    best = loglik(f.beta, f.theta)
    for db, dt in ((1e-3, 0), (-1e-3, 0), (0, 1e-2), (0, -1e-2), (1e-3, 1e-2)):
        assert best >= loglik(f.beta + db, f.theta + dt)
    assert f.theta == pytest.approx(theta, rel=0.15) and f.beta == pytest.approx(0.4, rel=0.05)
    with pytest.raises(ValueError):
        nb.fit_dispersion(df.withColumn("w", F.lit(-0.1)))


def _herd(farms, rng, years=(2001, 2002)):
    import pandas as pd
    rows = []
    for f in range(farms):
        for y in years:
            for loc in range(2):
                for week in (20, 24, 28):
                    a = rng.normal()
                    rows.append((f"F{f}", y, f"F{f}_L{loc}_{y}", "None", 20.0, 12, a, 0.5 * a + 0.1 * (f % 7) + rng.normal(0, 0.1), 15))
    return pd.DataFrame(rows, columns=["Farm", "Year", "LocationYear", "Hygiene", "TotalAnimals", "Week", "a", "meanLogFEC", "TotalFEC"])


@pytest.mark.parametrize("terms", [("a",), ("factor(Farm)", "a")])
def test_any_number_of_farms(spark, terms):
    from herdcast.operators.group_model import fit_group_model
    from herdcast.schema import ModelSpec
    farms = 250
    group = spark.createDataFrame(_herd(farms, np.random.default_rng(1)))
    g = fit_group_model(group, ModelSpec(terms=terms))
    assert abs(g.coefficients["a"] - 0.5) < 0.05
    assert g.folds.count() == 2 * farms


def test_forty_farms_match_dense(spark):
    pdf = frame(seed=9, farms=40, locs=1, years=2, weeks=5)
    df = spark.createDataFrame(pdf).withColumns({"Hygiene": F.lit("None"), "TotalAnimals": F.lit(9)})
    g = gm.fit_group_model(df, SPEC, Options())
    assert g.names[0] == "(Intercept)" and len(g.names) == 43
    used = pdf[pdf["TotalFEC"] >= 10]
    X = np.column_stack([np.ones(len(used)), *[used["Farm"] == f for f in g.levels["Farm"][1:]], used["a"], used["b"], used["b"] ** 2 / 10]).astype(float)
    args = [used[c].to_numpy() for c in ("meanLogFEC", "TotalFEC", "LocationYear", "Year")]
    _, want, s2, _ = dense(X, *args, g.fit.ratio_group, g.fit.ratio_year)
    np.testing.assert_allclose(list(g.coefficients.values()), want, rtol=1e-6, atol=1e-8)
    assert g.fit.sigma2 == pytest.approx(s2, rel=1e-6)


def test_two_thousand_farms_take_little_memory(spark):
    """What reaches the driver, and what a task holds beside its farm, depends on years and terms only."""
    from herdcast.operators import arrow as ar

    def noise(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10007)) / 10007.0 - 0.5
    herd = (spark.range(2000 * 12).withColumns({"Farm": F.concat(F.lit("F"), (F.col("id") / 12).cast("int")), "k": F.col("id") % 12})
            .withColumns({"Year": (2001 + F.col("k") % 2).cast("int"), "a": noise(1), "Hygiene": F.lit("None"), "TotalAnimals": F.lit(20.0), "TotalFEC": F.lit(15)})
            .withColumn("LocationYear", F.concat_ws("_", "Farm", (F.col("k") % 4).cast("string"), "Year"))
            .withColumn("meanLogFEC", 0.5 * F.col("a") + F.pmod(F.hash("Farm"), F.lit(7)) * 0.1 + 0.2 * noise(2)))
    g = gm.fit_group_model(herd, ModelSpec(terms=("factor(Farm)", "a")))
    assert len(g.farms) == 2000 and g.folds.where("farm_effect IS NOT NULL").count() == 4000
    assert ar.Sums.zero(97, 2 + 2).z.nbytes < 20_000
    assert abs(g.coefficients["a"] - 0.5) < 0.01
    left = herd.groupBy("Farm").agg(F.avg(F.col("meanLogFEC") - g.coefficients["a"] * F.col("a")).alias("m")).collect()
    got = [g.farms[r.Farm] for r in left]
    assert np.corrcoef(got, [r.m for r in left])[0, 1] > 0.999


def test_every_farm_year_has_a_fold_and_unseen_farms_have_no_prediction(spark):
    import pandas as pd
    from pyspark.sql import functions as F

    from herdcast.operators.group_model import fit_group_model, predict_excluded, predict_single
    from herdcast.schema import ModelSpec
    frame = _herd(4, np.random.default_rng(2))
    small = frame[frame.Farm == "F1"].assign(Year=2003, TotalFEC=1)
    group = spark.createDataFrame(pd.concat([frame, small]))
    g = fit_group_model(group, ModelSpec(terms=("factor(Farm)", "a")))
    out = predict_excluded(group, g, "p").where("Year = 2003")
    assert out.count() == 12 and out.where("p IS NULL").count() == 0
    new = group.limit(1).withColumn("Farm", F.lit("new"))
    assert predict_single(new, g, "p").first().p is None
