"""Forecast: every sampled location-week to each animal's state four weeks ahead.

One set-based job. A feature depends on an animal and a target week only, so target weeks
are computed once however many samplings ask for them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdcast.functions import expr as X
from herdcast.operators import checks as C
from herdcast.operators import features as ft
from herdcast.operators import lags as L
from herdcast.operators.backfit import DOSE_FLAGS
from herdcast.operators.group_model import GroupFit, predict_single
from herdcast.plans.report import check_pm
from herdcast.plans.train import FittedModels
from herdcast.schema import Options
from herdcast.session import materialise

RISK_THRESHOLDS = {"VeryHigh": 600.0, "High": 1000.0, "Normal": 2000.0}
PAST, FUTURE = "past", "future"


def limit_to_weather(fec: DataFrame, rolling: DataFrame) -> DataFrame:
    """Rows whose target week (four ahead) is still within the year's rolling weather."""
    last = rolling.groupBy("Year").agg(F.max("Week").alias("_last"))
    return fec.join(last, "Year").filter(F.col("Week") + 4 <= F.col("_last")).drop("_last")


def target_weeks(samplings: DataFrame) -> DataFrame:
    """Per location-year, the weeks whose state is needed (a set bounded by the calendar).

    The weeks 8, 4 and 0 before a sampling are judged with what was known then; the week 4
    after it only with what is known at the sampling.
    """
    want = F.array(*[F.struct((F.col("Week") + k).alias("Target"), F.lit(kind).alias("Kind"))
                     for k, kind in ((-8, PAST), (-4, PAST), (0, PAST), (4, FUTURE))])
    return (samplings.select("Location", "Year", F.explode(want).alias("t"))
            .groupBy("Location", "Year").agg(F.collect_set("t").alias("targets")))


def forecast_features(fec: DataFrame, samplings: DataFrame) -> DataFrame:
    """Lags, treatments and last dose of every animal at every target week of its location.

    Facts and target rows share one window per animal and year, so the as-of lookups and
    all lag bands take a single shuffle and sort.
    """
    facts = fec.select("AnimalID", "Location", "Year", "Week", "FEC", "Dose", "LastDose",
                       F.lit(None).cast("array<string>").alias("Kinds"))
    animals = fec.select("AnimalID", "Location", "Year").distinct()
    # a week asked for in both ways is one row in the frames
    asked_weeks = target_weeks(samplings).select("Location", "Year", F.transform(
        F.array_distinct("targets.Target"), lambda w: F.struct(w.alias("Week"), F.transform(
            F.filter("targets", lambda t: t["Target"] == w), lambda t: t["Kind"]).alias("Kinds"))).alias("weeks"))
    # written, so that its size is known: the animals are not shuffled by location to meet it
    asked = (animals.join(materialise(asked_weeks, "asked"), ["Location", "Year"])
             .select("AnimalID", "Location", "Year", F.explode("weeks").alias("t"))
             .select("AnimalID", "Location", "Year", F.col("t.Week").alias("Week"),
                     F.lit(None).cast("double").alias("FEC"),
                     F.lit(None).cast("boolean").alias("Dose"),
                     F.lit(None).cast("double").alias("LastDose"), F.col("t.Kinds").alias("Kinds")))
    order = W.partitionBy("AnimalID", "Location", "Year").orderBy("Week")

    def band(near: int, far: int):
        return order.rangeBetween(-far, -near)

    def last_dose(near: int) -> Column:
        told = F.last(F.col("Week") - F.col("LastDose"), True).over(band(near, 24))
        seen = F.max(F.when(F.col("Dose"), F.col("Week"))).over(band(near, 24)).cast("double")
        return F.greatest(told, seen)
    cols = {n: F.avg(F.log1p("FEC")).over(band(*b)) for n, b in L.FEC_BANDS.items()}
    cols |= {n: F.coalesce(F.bool_or("Dose").over(band(*b)), F.lit(False))
             for n, b in L.DOSE_BANDS.items()}
    cols["ObservedFEC"] = F.max("FEC").over(order.rangeBetween(0, 0))
    cols |= {"_past": last_dose(1), "_future": last_dose(5)}
    rows = facts.unionByName(asked).select("AnimalID", "Location", "Year", "Week", "Kinds",
                                           *[c.alias(n) for n, c in cols.items()])
    dose_week = F.when(F.col("Kind") == PAST, F.col("_past")).otherwise(F.col("_future"))
    return (rows.filter(F.col("Kinds").isNotNull()).withColumn("Kind", F.explode("Kinds"))
            .withColumn("LastDose", F.coalesce(F.col("Week") - dose_week, F.lit(X.INF)))
            .select("AnimalID", "Location", "Year", F.col("Week").alias("Target"), "Kind",
                    *[n for n in cols if not n.startswith("_")], "LastDose"))


def location_state(features: DataFrame, options: Options = Options()) -> DataFrame:
    """Location totals at each target week: animals, treatment bands, observed mean."""
    d = F.col("LastDose")
    within = {k: F.count_if(d <= k) for k in (4, 8, 12)}
    state = features.groupBy("Farm", "Location", "Hygiene", "Year", "Target", "Kind").agg(
        F.count(F.lit(1)).alias("TotalAnimals"), F.avg("Age").alias("MeanAge"),
        within[4].alias("DosedWithin4"), (within[8] - within[4]).alias("DosedWithin8"),
        (within[12] - within[8]).alias("DosedWithin12"),
        F.avg(F.log1p("ObservedFEC")).alias("ObservedMean"),
        F.count("ObservedFEC").alias("Observed"))
    state = state.withColumnRenamed("Target", "Week")
    return ft.with_season_terms(ft.with_group_doses(state, options))


def predicted_state(features: DataFrame, group: GroupFit, rolling: DataFrame,
                    options: Options = Options()) -> DataFrame:
    """Group prediction of each location at each target week (no random effects).

    Past weeks use their treatment terms and give a residual when at least five animals
    were counted; future weeks are predicted without treatment terms.
    """
    future = F.col("Kind") == FUTURE
    state = location_state(features, options).withColumns({
        f"DoseProp{k}": F.when(future, F.lit(0.0)).otherwise(F.col(f"DoseProp{k}"))
        for k in (4, 8, 12)})
    state = state.join(rolling, ["Year", "Week"])
    state = predict_single(state, group, "Prediction")
    residual = F.when(~future & (F.col("Observed") >= 5),
                      F.col("Prediction") - F.col("ObservedMean"))
    return state.select("Farm", "Location", "Hygiene", "Year", "Week", "Kind", "Prediction",
                        residual.alias("Residual"))


def group_residual_recent(samplings: DataFrame, state: DataFrame) -> DataFrame:
    """Per sampling: group prediction four weeks ahead and the residuals at 0, 4, 8 weeks ago."""
    past = F.col("Kind") == PAST
    spread = F.explode(F.array(
        F.struct(F.lit(4).alias("slot"), F.col("Week").alias("Sampled"), past.alias("ok")),
        F.struct(F.lit(8).alias("slot"), (F.col("Week") + 4).alias("Sampled"), past.alias("ok")),
        F.struct(F.lit(12).alias("slot"), (F.col("Week") + 8).alias("Sampled"), past.alias("ok")),
        F.struct(F.lit(0).alias("slot"), (F.col("Week") - 4).alias("Sampled"),
                 (~past).alias("ok"))))
    slots = (state.withColumn("s", spread).filter("s.ok")
             .groupBy("Location", "Year", F.col("s.Sampled").alias("Week"))
             .agg(F.max(F.when(F.col("s.slot") == 0, F.col("Prediction"))).alias("GroupPrediction"),
                  *[F.max(F.when(F.col("s.slot") == k, F.col("Residual")))
                    .alias(f"residual_location{k}") for k in (4, 8, 12)]))
    return samplings.join(slots, ["Location", "Year", "Week"], "left")


def _linear(parts: dict[str, float], values: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for name, b in parts.items():
        if not math.isnan(b):
            total = total + values[name] * F.lit(float(b))
    return total


def predict_animals(rows: DataFrame, models: FittedModels, threshold: float) -> DataFrame:
    """Animal forecast: common effects + location offset + offset of the animal's own tier."""
    c, spec = models.chain.centering, models.spec

    def less(col: str, mean: str) -> Column:
        return F.col(col) - F.lit(float(c.get(mean, 0.0)))
    last = F.coalesce(F.log1p("AvFEC") - F.lit(float(c.get("feclastyearmean", 0.0))), F.lit(0.0))
    one = F.lit(1.0)
    common_values: dict[str, Column] = {"(Intercept)": one}
    rows = rows.withColumn("LastDoseCat", X.last_dose_category(F.col("LastDose")))
    for factor in ("Sex", "AgeCat", "LastDoseCat"):
        for level in models.chain.levels[factor]:
            common_values[factor + level] = (F.col(factor) == level).cast("double")
    common = _linear(models.chain.common, common_values)
    group_offset = F.lit(0.0)
    for k in (12, 8, 4):
        r = less(f"residual_location{k}", f"res{k}mean")
        values = {f"residual_location{k}": r, f"residual_location{k}:cdoy": r * F.col("cdoy"),
                  f"residual_location{k}:sdoy": r * F.col("sdoy")}
        group_offset = F.when(F.col(f"residual_location{k}").isNotNull(),
                              _linear(models.chain.residual[k], values)).otherwise(group_offset)
    own_offset = _linear(models.chain.individual[0], {"lastYearMeanFEC": last, "(Intercept)": one})
    for k in (12, 8, 4):
        f = less(f"fec{k}wk", f"fec{k}wkmean")
        values = {f"fec{k}wk": f, "lastYearMeanFEC": last, "(Intercept)": one}
        if spec.txtime:
            flag = DOSE_FLAGS[spec.txtime][k]
            values[f"fec{k}wk:{flag}TRUE"] = F.when(F.col(flag), f).otherwise(F.lit(0.0))
            values[f"fec{k}wk:{flag}FALSE"] = F.when(~F.col(flag), f).otherwise(F.lit(0.0))
        own_offset = F.when(F.col(f"fec{k}wk").isNotNull(),
                            _linear(models.chain.individual[k], values)).otherwise(own_offset)
    mean = F.col("GroupPrediction") + common + group_offset + own_offset
    prob = X.threshold_probability(F.col("PredictedMean"), threshold,
                                   models.dispersion.residual_sd)
    return (rows.withColumn("PredictedMean", mean)
            .select("Farm", "Location", "Year", F.col("Target").alias("Week"), "AnimalID",
                    F.expm1("fec4wk").alias("LastFEC"),
                    F.bround(F.expm1("GroupPrediction"), 0).alias("PredictedGroupMean"),
                    F.bround(F.expm1("PredictedMean"), 0).alias("PredictedAnimalMean"),
                    F.bround(prob, 2).alias("ThresholdProbability"), "ObservedFEC", "LastDose"))


def sheet_facts(fec: DataFrame, models: FittedModels) -> DataFrame:
    """Facts at known locations whose target week has weather."""
    return limit_to_weather(fec.filter(F.col("Location").isNotNull()), models.rolling)


def forward_predict(fec: DataFrame, animal: DataFrame, locations: DataFrame,
                    models: FittedModels, threshold: float = 2000.0) -> DataFrame:
    """Predictions of every animal four weeks after every sampling of its location.

    The facts and the animal states are written once, as several branches read each.
    """
    options = models.options
    facts = materialise(sheet_facts(fec, models), "sheet-facts")
    unseen = locations.select("Farm", "Hygiene").distinct()
    for name, levels in models.group.levels.items():
        if f"factor({name})" in models.spec.terms and name in unseen.columns:
            C.require(unseen.filter(~F.col(name).isin(levels)).select(name), f"{name} was not in the fitted data")
    samplings = ft.sampling_events(facts, animal, locations, options)
    hyg = locations.select("Farm", "Location", "Year", "Hygiene")
    attrs = (animal.filter(F.col("Location").isNotNull())
             .select("AnimalID", "Location", "Year", "Farm", "Sex", "Age", "AgeCat", "AvFEC")
             .join(hyg, ["Farm", "Location", "Year"], "left"))
    features = materialise(forecast_features(facts, samplings).join(
        attrs, ["AnimalID", "Location", "Year"], "left"), "forecast-features")
    state = predicted_state(features, models.group, models.rolling, options)
    recent = group_residual_recent(
        samplings.select("Location", "Year", "Week"), state)
    target = (recent.withColumn("Target", F.col("Week") + 4).drop("Week")
              .withColumns({"sdoy": X.sdoy(F.col("Target")), "cdoy": X.cdoy(F.col("Target"))}))
    rows = features.filter(F.col("Kind") == FUTURE).join(target, ["Location", "Year", "Target"])
    return predict_animals(rows, models, threshold)


def demographic_score(pm: dict[str, float]) -> Column:
    """Logit of the demographic model from AgeCat, Sex, Week and AvFEC."""
    def lookup(prefix: str, col: str) -> Column:
        out = None
        for name, v in pm.items():
            if name.startswith(prefix):
                hit = F.col(col) == name[len(prefix):]
                out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
        return out
    return (F.lit(pm["PM_Intercept"]) + lookup("PM_AgeCat", "AgeCat")
            + X.cdoy(F.col("Week")) * pm["PM_cdoy"] + X.sdoy(F.col("Week")) * pm["PM_sdoy"]
            + F.col("AvFEC") * (pm["PM_I(meanFEC/1000)"] / 1000) + lookup("PM_Sex", "Sex"))


def demographic_risk(rows: DataFrame, pm: dict[str, float], threshold: float, mean_fec: float
                     ) -> DataFrame:
    rows = rows.withColumn("AvFEC", F.coalesce("AvFEC", F.lit(mean_fec)))
    rows = rows.withColumn("DemographicProb", demographic_score(pm))
    return rows.withColumn("DemographicRisk", F.when(
        X.logistic(F.col("DemographicProb")) > threshold, "Elevated").otherwise(""))


def overall_risk(clinical: Column, demographic: Column, downgrade_very_high: bool = False) -> Column:
    """Very high clinical risk stands; otherwise an elevated demographic risk means High.

    ``downgrade_very_high`` reproduces the older rule that lost the very high level.
    """
    raised = F.when(demographic == "Elevated", F.lit("High")).otherwise(clinical)
    if downgrade_very_high:
        return raised
    return F.when(clinical == "VeryHigh", clinical).otherwise(raised)


def risk_table(samplings: DataFrame, animal: DataFrame, pm: dict[str, float], threshold: float,
               mean_fec: float, downgrade_very_high: bool = False) -> DataFrame:
    """Demographic and overall risk of each animal, four weeks before each sampling."""
    rows = (samplings.withColumn("Week", F.col("Week") - 4)
            .join(animal.drop("Field"), ["Farm", "Location", "Year"], "left"))
    rows = demographic_risk(rows, pm, threshold, mean_fec)
    risk = overall_risk(F.col("ClinicalRisk"), F.col("DemographicRisk"), downgrade_very_high)
    return rows.withColumn("OverallRisk", risk).select(
        "Farm", "Location", "Year", "Hygiene", "TotalAnimals", "MeanAge", "Week", "AnimalID",
        "Tag", "DemographicProb", "ClinicalRisk", "DemographicRisk", "OverallRisk")


def dose_decision(rows: DataFrame, prob_threshold: float = 0.35,
                  thresholds: dict[str, float] = RISK_THRESHOLDS) -> DataFrame:
    """Dose by the model, dose by the animal's own count, and the label of its last dose."""
    limit = F.create_map(*[F.lit(x) for kv in thresholds.items() for x in kv])
    last = F.col("LastDose")
    label = F.when(last > 52, "None").otherwise(F.concat(
        F.lit("Week "), F.when(last <= 52, F.col("Week") + 4 - last).cast("int").cast("string")))
    return rows.withColumns({
        "ModelDose": F.col("ThresholdProbability") >= prob_threshold,
        "IndividDose": F.coalesce(
            F.col("LastFEC") >= F.try_element_at(limit, F.col("OverallRisk")), F.lit(False)),
        "LastDose": label})


def prediction_report(rows: DataFrame) -> DataFrame:
    """The report columns, with the animal's short name."""
    return rows.select(
        "Farm", "Location", "Year", "Week",
        F.regexp_replace("AnimalID", r"^.*_", "").alias("Donkey"), "Tag",
        F.bround("DemographicProb", 2).alias("DemographicProb"), "ClinicalRisk",
        "DemographicRisk", "OverallRisk", "LastFEC", "LastDose",
        F.col("PredictedAnimalMean").alias("PredMean"),
        F.col("ThresholdProbability").alias("Pthresh"))


def get_predictions(fec: DataFrame, animal: DataFrame, locations: DataFrame, models: FittedModels,
                    pm: dict[str, float], pm_threshold: float, prob_threshold: float = 0.35,
                    thresholds: dict[str, float] = RISK_THRESHOLDS, validate_only: bool = True,
                    downgrade_very_high: bool = False) -> tuple[DataFrame, DataFrame]:
    """Raw predictions and processed decisions.

    ``validate_only`` keeps the samplings whose target week was sampled as well;
    otherwise every sampling keeps its decisions.
    """
    if sorted(thresholds.values()) != [thresholds[k] for k in ("VeryHigh", "High", "Normal")]:
        raise ValueError("the three thresholds must rise from VeryHigh to Normal")
    check_pm(pm, pm_threshold)
    if not 0 < prob_threshold < 1:
        raise ValueError("prob_threshold must lie strictly between 0 and 1")
    raw = forward_predict(fec, animal, locations, models, max(thresholds.values()))
    samplings = ft.sampling_events(sheet_facts(fec, models), animal, locations,
                                   models.options).drop("n")
    if not validate_only:
        samplings = samplings.withColumn("Week", F.col("Week") + 4)
    mean_fec = math.expm1(models.chain.centering.get("feclastyearmean", 0.0))
    risks = risk_table(samplings, animal, pm, pm_threshold, mean_fec, downgrade_very_high)
    both = raw.withColumn("Week", F.col("Week") - 4).join(
        risks, ["Farm", "Location", "Year", "Week", "AnimalID"])
    return raw, dose_decision(both, prob_threshold, thresholds)

