"""Model fits. The numerics have no SQL form; the one-pass pieces do."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdcast import fixtures as fx
from herdcast.operators import backfit as bf
from herdcast.operators import features as ft
from herdcast.operators import group_model as gm
from herdcast.operators import weather as wx
from herdcast.plans import report, train
from herdcast.queries.base import query, round_doubles, s6, scratch
from herdcast.schema import DEFAULT_TERMS, ModelSpec
from herdcast.session import materialise
from herdcast.sources import readers, sinks

_FITTED: dict[tuple, train.FittedModels] = {}
_FACTS: dict[tuple, DataFrame] = {}


def herd(spark, d) -> train.HerdTables:
    return train.HerdTables(fx.locations(spark, d), fx.animal(spark, d), fx.fec(spark, d),
                            fx.weather(spark, d))


def herd_written(spark, d) -> train.HerdTables:
    """The tables with the facts written, once per application: the fit and what is predicted with it read them."""
    key, t = (spark.sparkContext.applicationId, d), herd(spark, d)
    if key not in _FACTS:
        _FACTS[key] = materialise(t.fec, "herd-facts")
    return replace(t, fec=_FACTS[key])


def fitted(spark, d) -> train.FittedModels:
    """The default fit of these tables, made once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        _FITTED[key] = train.fit_models(herd_written(spark, d), validate=False)   # weather starts after the first Monday
    return _FITTED[key]


def forget() -> None:
    _FITTED.clear()
    _FACTS.clear()


def pm(spark) -> dict[str, float]:
    return {r["term"]: r["estimate"] for r in fx.pm_coefficients(spark).collect()}


def _named(spark, rows, columns="model string, term string, estimate double"):
    clean = [tuple(None if isinstance(v, float) and math.isnan(v) else
                   (float(v) if hasattr(v, "dtype") else v) for v in r) for r in rows]
    return spark.createDataFrame(clean, columns)


_TERMS = ["(Intercept)", "FarmFARM_1", "HygieneAutomated", "HygieneManual"] + [
    t for t in DEFAULT_TERMS if not t.startswith("factor")]


def _term_sql(t: str) -> str:
    if t == "(Intercept)":
        return "1.0"
    if t.startswith("Farm"):
        return f"CASE WHEN Farm = '{t[4:]}' THEN 1.0 ELSE 0.0 END"
    if t.startswith("Hygiene"):
        return f"CASE WHEN Hygiene = '{t[7:]}' THEN 1.0 ELSE 0.0 END"
    if t.startswith("log("):
        return f"ln({t[4:-1]})"
    if "^2" in t:
        c = t.split("^")[0]
        return f"{c} * {c} / 10"
    if t.startswith("DoseProp"):
        k = t[8:]
        return (f"ln((TotalAnimals - DosedWithin{k}) / TotalAnimals"
                f" + 0.05 * DosedWithin{k} / TotalAnimals)")
    return t


@query("design_matrix", " UNION ALL ".join(
    f"SELECT '{'I(' + t + ')' if '^2' in t else t}' AS term, count({_term_sql(t)}) AS n, "
    f"{s6(f'avg({_term_sql(t)})')} AS mean FROM full_rows" for t in _TERMS), ["full_rows"])
def design_matrix(spark, d):
    t = herd(spark, d)
    rolling = wx.rolling_weather(t.weather)
    group = ft.group_model_data(t.fec, t.animal, t.locations, rolling)
    levels = {"Farm": gm.level_counts(group, "Farm"), "Hygiene": ["None", "Automated", "Manual"]}
    design = gm.expand_terms(DEFAULT_TERMS, levels)
    cols = group.select(*[c.alias(f"x{i}") for i, c in enumerate(design.values())])
    stats = cols.agg(F.array(*[F.struct(
        F.lit(n).alias("term"), F.count(f"x{i}").alias("n"), F.avg(f"x{i}").alias("mean"))
        for i, n in enumerate(design)]).alias("m"))
    return round_doubles(stats.select(F.inline("m")))


_GIVEN = {t: round(0.03 * (i % 5) - 0.05, 2) for i, t in enumerate(_TERMS)}
_LEVELS = {"Farm": ["FARM_0", "FARM_1"], "Hygiene": ["None", "Automated", "Manual"]}


@query("predict_group_stored", f"""
SELECT Location, Year, Week, {s6(' + '.join(f'{v} * ({_term_sql(t)})' for t, v in _GIVEN.items()))} AS Prediction,
  {s6(' + '.join(f'{v} * ({_term_sql(t)})' for t, v in _GIVEN.items() if not t.startswith('DoseProp')))} AS Untreated
FROM full_rows""", ["full_rows"])
def predict_group_stored(spark, d):
    """Coefficients written as a list, read back, and applied to every location-week."""
    t = herd(spark, d)
    group = ft.group_model_data(t.fec, t.animal, t.locations, wx.rolling_weather(t.weather))
    title = "Group Coefficients:"
    names = [f"I({n})" if "^2" in n else n for n in _GIVEN]
    lines = [(0, title, None), (1, "", None), *[(i + 2, n, v) for i, (n, v) in enumerate(zip(names, _GIVEN.values()))]]
    path = scratch(spark, "given-coefficients")
    sinks.write_coefficients(spark.createDataFrame(lines, "ord int, groupcoefnames string, groupcoefs double"), path)
    fit = gm.stored_group_fit(group, readers.read_coefficients(spark, path)[title], _LEVELS)
    return round_doubles(gm.predict_excluded(group, fit, "Prediction", "Untreated").select(
        "Location", "Year", "Week", "Prediction", "Untreated"))


@query("fit_group_lmm")
def fit_group_lmm(spark, d):
    g = fitted(spark, d).group
    rows = [("group", n, v) for n, v in g.coefficients.items()]
    rows += [("variance", "residual", g.fit.sigma2),
             ("variance", "LocationYear", g.fit.sigma2 * g.fit.ratio_group),
             ("variance", "Year", g.fit.sigma2 * g.fit.ratio_year)]
    rows += [("Year", str(y), e) for y, e in g.fit.year_effect.items()]
    return _named(spark, rows)


@query("fit_group_lmm_excluding")
def fit_group_lmm_excluding(spark, d):
    return gm.fold_coefficients(fitted(spark, d).group)


@query("predict_group")
def predict_group(spark, d):
    return fitted(spark, d).every.select(
        "AnimalID", "Location", "Monday", "GroupPredictionIncTx", "GroupPredictionNoTx")


@query("prediction_grid")
def prediction_grid(spark, d):
    m = fitted(spark, d)
    real = gm.prediction_grid(m.group, m.group_data, m.rolling).withColumn("weather", F.lit("real"))
    mean = gm.prediction_grid(m.group, m.group_data, None).withColumn("weather", F.lit("mean"))
    return real.unionByName(mean)


@query("location_week_means")
def location_week_means(spark, d):
    return ft.location_week_means(fitted(spark, d).every, "GroupPredictionIncTx")


@query("location_residuals")
def location_residuals(spark, d):
    m = fitted(spark, d)
    c = m.chain.centering
    return m.rows.select("AnimalID", "Location", "Monday", *[
        (F.col(f"residual_location{k}") - c[f"res{k}mean"]).alias(f"residual_location{k}")
        for k in (4, 8, 12)])


@query("fit_common_lmm")
def fit_common_lmm(spark, d):
    chain = fitted(spark, d).chain
    return _named(spark, [("common", n, v) for n, v in chain.common.items()]
                  + [("ratio", "AnimalID", chain.animal_ratio)])


_SLOPES = {k: v for k, v in bf.SLOPE_MODELS.items() if k.startswith("ind_")}


def _slope_sql(model: str, terms: tuple[str, ...]) -> str:
    x = [f"({t} - {'m_' + t})" for t in terms]
    where = " AND ".join(f"{t} IS NOT NULL" for t in terms)
    src = ("(SELECT *, " + ", ".join(f"avg({t}) OVER () AS m_{t}" for t in
                                     ("lastYearMeanFEC", "fec4wk", "fec8wk", "fec12wk"))
           + " FROM history)")
    if len(x) == 1:
        return (f"SELECT '{model}' AS model, '{terms[0]}' AS term, "
                f"{s6(f'sum({x[0]} * Obs) / sum({x[0]} * {x[0]})')} AS estimate "
                f"FROM {src} WHERE {where}")
    sums = (f"(SELECT sum({x[0]} * {x[0]}) AS a, sum({x[0]} * {x[1]}) AS b, "
            f"sum({x[1]} * {x[1]}) AS c, sum({x[0]} * Obs) AS u, sum({x[1]} * Obs) AS v "
            f"FROM {src} WHERE {where})")
    return (f"SELECT '{model}', '{terms[0]}', {s6('(c * u - b * v) / (a * c - b * b)')} FROM {sums} "
            f"UNION ALL SELECT '{model}', '{terms[1]}', "
            f"{s6('(a * v - b * u) / (a * c - b * b)')} FROM {sums}")


@query("fit_offset_slopes", " UNION ALL ".join(
    _slope_sql(m, t) for m, t in _SLOPES.items()), ["history"])
def fit_offset_slopes(spark, d):
    t = herd(spark, d)
    rows = ft.history_features(ft.individual_rows(t.fec, t.animal, t.locations)).select(
        "Obs", "lastYearMeanFEC", "fec4wk", "fec8wk", "fec12wk")
    rows = materialise(rows, "slopes")
    means = ft.center_means(rows).first()
    rows = rows.withColumns({c: F.col(c) - means[k] for k, c in ft.CENTRES.items()
                             if c in rows.columns})
    return round_doubles(bf.fit_offset_slopes(rows, _SLOPES))


@query("backfit_loop")
def backfit_loop(spark, d):
    c = fitted(spark, d).chain
    rows = [("common", n, v) for n, v in c.common.items()]
    rows += [(f"residual_{k}", n, v) for k, p in c.residual.items() for n, v in p.items()]
    rows += [(f"ind_{k}", n, v) for k, p in c.individual.items() for n, v in p.items()]
    rows += [("centre", n, v) for n, v in c.centering.items()]
    return _named(spark, rows)


@query("fit_nb_dispersion")
def fit_nb_dispersion(spark, d):
    f = fitted(spark, d).dispersion
    return _named(spark, [("negbin", "totpred", f.beta), ("negbin", "theta", f.theta),
                          ("negbin", "residual_sd", f.residual_sd)])


@query("model_compare")
def model_compare(spark, d):
    t = herd(spark, d)
    span = t.fec.agg(F.min("Year"), F.max("Year")).first()
    shorter = train.fit_models(t, years=range(span[0], span[1]), validate=False)
    p = pm(spark)
    a, b = (report.coefficient_table(spark, m, p, fx.PM_THRESHOLD)
            for m in (fitted(spark, d), shorter))
    return report.coefficient_compare(a, b)


VARIANTS = {
    "without animal effect": ModelSpec(common_re=False),
    "individual intercepts": ModelSpec(individual_intercept=True),
    "seasonal residuals": ModelSpec(resid_doy_interaction=True),
    "location offsets": ModelSpec(use_location_offsets=True),
    "treated counts apart, 8 weeks": ModelSpec(txtime=8),
    "treated counts removed, 12 weeks": ModelSpec(txtime=12, txrm=True)}


@query("model_options")
def model_options(spark, d):
    rows = []
    for name, spec in VARIANTS.items():
        base = fitted(spark, d).rows
        chain = bf.fit_backfit(bf.prepare_rows(base, spec) if spec.txrm else base, spec)
        rows += [(name, n, new) for n, new, _ in chain.convergence]
    return _named(spark, rows)


@query("convergence_table")
def convergence_table(spark, d):
    return report.convergence_table(spark, fitted(spark, d))


@query("coefficient_table")
def coefficient_table(spark, d):
    return report.coefficient_table(spark, fitted(spark, d), pm(spark), fx.PM_THRESHOLD)


@query("coefficient_compare")
def coefficient_compare(spark, d):
    a = coefficient_table(spark, d)
    scaled = a.withColumn("groupcoefs", F.col("groupcoefs") * 1.1)
    return report.coefficient_compare(scaled, a)


@query("write_coefficients")
def write_coefficients(spark, d):
    table = report.coefficient_table(spark, fitted(spark, d), pm(spark), fx.PM_THRESHOLD,
                                     layout=True)
    path = scratch(spark, "coefficients")
    sinks.write_coefficients(table, path)
    return spark.read.schema("groupcoefnames string, groupcoefs double").csv(path)


@query("observed_vs_predicted")
def observed_vs_predicted(spark, d):
    m = fitted(spark, d)
    return report.observed_vs_predicted(m.group, m.group_data, m.rolling)


@query("location_year_extremes")
def location_year_extremes(spark, d):
    m = fitted(spark, d)
    return report.location_year_effects(m.group_data, m)
