"""Tables behind the reports: coefficients, comparison, observed against predicted."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdcast.operators import features as ft
from herdcast.operators.group_model import GroupFit, prediction_grid
from herdcast.plans.train import FittedModels
from herdcast.schema import AGE_LEVELS, DOSE_CAT_LEVELS, HYGIENE_LEVELS, PM_TERMS, SEX_LEVELS

# The weather terms listed in the coefficient table, per lag.
WEATHER_TERMS = ("Temp_frost_{k}", "I(Temp_frost_{k}^2/10)", "Temp_avg_{k}",
                 "I(Temp_avg_{k}^2/10)", "AbsHumid_{k}", "I(AbsHumid_{k}^2/10)",
                 "RelHumid_{k}", "I(RelHumid_{k}^2/100)")
WEATHER_TERM_LAGS = (4, 8, 12, 16, 20)


def check_pm(pm: dict[str, float], threshold: float) -> None:
    """The demographic model must hold exactly its fixed terms, in order."""
    if tuple(pm) != PM_TERMS:
        raise ValueError("the demographic coefficients must be " + ", ".join(PM_TERMS))
    if not 0 < threshold < 1:
        raise ValueError("the demographic threshold must lie strictly between 0 and 1")


def _section(values: dict[str, float], names: list[str]) -> list[tuple[str, float]]:
    return [(n, 0.0 if math.isnan(values.get(n, 0.0)) else values.get(n, 0.0)) for n in names]


def coefficient_rows(m: FittedModels, pm: dict[str, float], pm_threshold: float
                     ) -> list[tuple[str, str, float]]:
    """(section, name, value) with every declared level in its declared order; absent terms are 0."""
    check_pm(pm, pm_threshold)
    lv, own = m.group.levels, m.chain
    weather = [t.format(k=k) for k in WEATHER_TERM_LAGS for t in WEATHER_TERMS]
    group_names = (["(Intercept)", "sdoy", "cdoy"] + [f"Farm{f}" for f in lv.get("Farm", [])]
                   + [f"Hygiene{h}" for h in HYGIENE_LEVELS] + ["MeanAge", "log(TotalAnimals)"]
                   + [f"DoseProp{k}" for k in (4, 8, 12)] + weather)
    group = _section(m.group.coefficients, group_names)
    group[0] = ("GroupIntercept", group[0][1])
    declared = {"Sex": SEX_LEVELS, "AgeCat": AGE_LEVELS, "LastDoseCat": DOSE_CAT_LEVELS}
    common_names = ["(Intercept)"] + [f + v for f, values in declared.items() for v in values]
    common = _section(own.common, common_names)
    common[0] = ("CommonIntercept", common[0][1])
    common.append(("ResidualSD", m.dispersion.residual_sd))
    residual = [(n, v) for k in (4, 8, 12) for n, v in own.residual[k].items()]
    individual = []
    for k in (0, 4, 8, 12):
        for n, v in own.individual[k].items():
            plain = k == 0 or n.startswith("fec")
            individual.append((n if plain else f"{n}_{k}wk", v))
    order = ("feclastyearmean", "fec4wkmean", "fec8wkmean", "fec12wkmean", "res4mean", "res8mean",
             "res12mean")
    constants = [("expected_efficacy", m.options.expected_efficacy)] + [
        (k, own.centering[k]) for k in order if k in own.centering]
    risk = list(pm.items()) + [("PM_threshold", pm_threshold)]
    sections = (("Group Coefficients:", group), ("Common Coefficients:", common),
                ("Residual Coefficients:", residual), ("Individual Coefficients:", individual),
                ("Constants:", constants), ("PM-based risk:", risk))
    return [(s, n, float(v)) for s, rows in sections for n, v in rows]


def coefficient_table(spark: SparkSession, m: FittedModels, pm: dict[str, float],
                      pm_threshold: float, layout: bool = False) -> DataFrame:
    """Ordered table (ord, section, groupcoefnames, groupcoefs).

    ``layout`` adds the title and blank lines of the written list.
    """
    out, last = [], None
    for section, name, value in coefficient_rows(m, pm, pm_threshold):
        if layout and section != last:
            if last is not None:
                out.append((last, "", None))
            out += [(section, section, None), (section, "", None)]
        out.append((section, name, None if math.isnan(value) else value))
        last = section
    if layout:
        out.append((last, "", None))
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(out)],
        "ord int, section string, groupcoefnames string, groupcoefs double")


def coefficient_compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two coefficient tables side by side with their difference."""
    key = ["section", "groupcoefnames"]
    a = old.select(*key, F.col("groupcoefs").alias("old"))
    b = new.select(*key, F.col("ord"), F.col("groupcoefs").alias("new"))
    return (b.join(a, key, "full").orderBy("ord")
            .select("section", "groupcoefnames", "old", "new",
                    (F.col("new") - F.col("old")).alias("difference")))


def convergence_table(spark: SparkSession, m: FittedModels) -> DataFrame:
    rows = [(i, n, None if math.isnan(new) else new, None if math.isnan(last) else last,
             None if not (new + last) or math.isnan(new + last)
             else abs((new - last) / ((new + last) / 2)))
            for i, (n, new, last) in enumerate(m.chain.convergence)]
    return spark.createDataFrame(
        rows, "ord int, name string, newcoefs double, lastcoefs double, reldiff double")


def observed_vs_predicted(group: GroupFit, group_data: DataFrame, rolling: DataFrame,
                          subtract_one: bool = True) -> DataFrame:
    """Excluded-fold curve and observed mean of every location-week.

    The curve of a farm and hygiene level is repeated for each of its locations that year;
    weeks with only one of the two stay.
    """
    minus = 1.0 if subtract_one else 0.0
    curve = (prediction_grid(group, group_data, rolling)
             .select("Year", "Farm", "Hygiene", "Week",
                     (F.col("PredExclusion") - minus).alias("Predicted"))
             .filter(F.col("Predicted").isNotNull()))
    members = group_data.select("Year", "Farm", "Hygiene", "Location").distinct()
    observed = group_data.select("Year", "Farm", "Week", "Hygiene", "Location",
                                 F.expm1("meanLogFEC").alias("Observed"),
                                 F.col("TotalFEC").alias("N"))
    both = (curve.join(members, ["Year", "Farm", "Hygiene"], "right")
            .join(observed, ["Year", "Farm", "Week", "Hygiene", "Location"], "full")
            .join(ft.mean_group_size(group_data), ["Year", "Farm", "Location"], "left"))
    short = F.replace(F.col("Location"), F.concat(F.col("Farm"), F.lit("_")), F.lit(""))
    return (both.withColumn("Location", short)
            .select("Year", "Farm", "Location", "Hygiene", "Week", "Predicted", "Observed", "N",
                    "MeanTotalFEC")
            .orderBy("Year", "Farm", "Location", "Week"))


def prediction_band(predictions: DataFrame, residual_sd: float, mean: str = "PredictedAnimalMean"
                    ) -> DataFrame:
    """Prediction and its 95% band on the count scale, in long form."""
    log_mean = F.log1p(mean)
    rows = predictions.withColumns({
        "MeanPred": F.expm1(log_mean), "UPred": F.expm1(log_mean + 1.96 * residual_sd),
        "LPred": F.expm1(log_mean - 1.96 * residual_sd)})
    keep = [c for c in predictions.columns]
    return rows.unpivot(keep, ["MeanPred", "UPred", "LPred"], "Type", "Value")


def location_year_effects(group_data: DataFrame, m: FittedModels) -> DataFrame:
    """Location-year random effects (BLUPs), one column per year.

    Per location-year the effect is t / (1 + t W) times the weighted residual sum, with
    fixed effects and the year effect taken out.
    """
    from herdcast.operators.group_model import predict_single
    t = m.group.fit.ratio_group
    w = F.col("TotalFEC").cast("double")
    rows = (predict_single(group_data.filter(F.col("TotalFEC") >= m.options.min_n), m.group, "_fixed", year=True)
            .withColumn("e", F.col("meanLogFEC") - F.col("_fixed")).filter(F.col("e").isNotNull()))
    per = rows.groupBy("Location", "Year").agg(F.sum(w).alias("W"), F.sum(w * F.col("e")).alias("s"))
    per = per.withColumn("Estimate", F.bround(F.col("s") * t / (F.lit(1.0) + F.col("W") * t), 2))
    span = group_data.agg(F.min("Year"), F.max("Year")).first()
    return per.groupBy("Location").pivot("Year", list(range(span[0], span[1] + 1))).agg(
        F.first("Estimate"))
