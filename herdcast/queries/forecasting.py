"""Forecast features, predictions, risks and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from herdcast import fixtures as fx
from herdcast.functions import expr as X
from herdcast.operators import features as ft
from herdcast.operators import weather as wx
from herdcast.plans import forecast as fc
from herdcast.plans import report
from herdcast.queries.base import query, r6, round_doubles, s6
from herdcast.queries.models import fitted, herd_written, pm
from herdcast.session import materialise


def _cut(cond: str) -> str:
    return f"FILTER (WHERE {cond})"


def _lag(a: int, b: int) -> str:
    return _cut(f"g.Target - f.Week BETWEEN {a} AND {b}")


_BEFORE = "g.Target - f.Week >= CASE g.Kind WHEN 'past' THEN 1 ELSE 5 END"
_FEATURES = f"""
SELECT g.AnimalID, g.Location, g.Year, g.Target, g.Kind,
  {', '.join(f"{s6(f'avg(ln(f.FEC + 1)) {_lag(a, b)}')} AS {n}" for n, a, b in
             (('fec4wk', 3, 5), ('fec8wk', 7, 9), ('fec12wk', 11, 13)))},
  {', '.join(f"coalesce(bool_or(f.Dose) {_lag(a, b)}, FALSE) AS dose{a}_{b}wk" for a, b in
             ((5, 12), (5, 16), (9, 16), (9, 20), (13, 20), (13, 24)))},
  max(f.FEC) {_cut('f.Week = g.Target')} AS ObservedFEC,
  coalesce(g.Target - greatest(max_by(f.Week - f.LastDose, f.Week) {_cut(_BEFORE)},
    max(f.Week) {_cut(_BEFORE + ' AND f.Dose')}), CAST('Infinity' AS DOUBLE)) AS LastDose
FROM (SELECT a.*, t.Target, t.Kind FROM (SELECT DISTINCT AnimalID, Location, Year FROM fec) a
  JOIN (SELECT DISTINCT Location, Year, Week + k AS Target, kind AS Kind
        FROM fec, (VALUES (-8, 'past'), (-4, 'past'), (0, 'past'), (4, 'future')) v(k, kind)
        WHERE Week BETWEEN 12 AND 48) t ON a.Location = t.Location AND a.Year = t.Year) g
LEFT JOIN fec f ON f.AnimalID = g.AnimalID AND f.Location = g.Location AND f.Year = g.Year
  AND f.Week BETWEEN g.Target - 24 AND g.Target
GROUP BY g.AnimalID, g.Location, g.Year, g.Target, g.Kind"""


@query("forecast_features", _FEATURES, ["fec"])
def forecast_features(spark, d):
    facts = materialise(fx.fec(spark, d), "facts")
    samplings = ft.sampling_events(facts, fx.animal(spark, d), fx.locations(spark, d))
    return round_doubles(fc.forecast_features(facts, samplings))


@query("limit_to_weather", """
SELECT AnimalID, Location, c.Year, c.Week, FEC FROM counts c
JOIN (SELECT Year, max(Week) AS w FROM rolling GROUP BY 1) r ON c.Year = r.Year
WHERE c.Week + 4 <= w""", ["counts", "rolling"])
def limit_to_weather(spark, d):
    rolling = wx.rolling_weather(fx.weather(spark, d), lags=(0,))
    return fc.limit_to_weather(fx.weekly_counts(spark, d), rolling).select(
        "AnimalID", "Location", "Year", "Week", "FEC")


@query("group_residual_recent")
def group_residual_recent(spark, d):
    m, t = fitted(spark, d), herd_written(spark, d)
    facts = materialise(fc.limit_to_weather(t.fec, m.rolling), "sheet-facts")
    samplings = ft.sampling_events(facts, t.animal, t.locations)
    attrs = t.animal.join(t.locations.select("Farm", "Location", "Year", "Hygiene"),
                          ["Farm", "Location", "Year"]).select(
        "AnimalID", "Location", "Year", "Farm", "Age", "Hygiene")
    features = fc.forecast_features(facts, samplings).join(
        attrs, ["AnimalID", "Location", "Year"], "left")
    state = fc.predicted_state(features, m.group, m.rolling)
    return fc.group_residual_recent(samplings.select("Location", "Year", "Week"), state)


@query("predict_animal")
def predict_animal(spark, d):
    t = herd_written(spark, d)
    return fc.forward_predict(t.fec, t.animal, t.locations, fitted(spark, d))


@query("prediction_decisions")
def prediction_decisions(spark, d):
    t = herd_written(spark, d)
    _, decided = fc.get_predictions(t.fec, t.animal, t.locations, fitted(spark, d), pm(spark),
                                    fx.PM_THRESHOLD)
    return fc.prediction_report(decided)


def pnorm_sql(x: str) -> str:
    num, den = "0.0352624965998911", "0.0883883476483184"
    for c in ("0.700383064443688", "6.37396220353165", "33.912866078383", "112.079291497871",
              "221.213596169931", "220.206867912376"):
        num = f"({num} * a + {c})"
    for c in ("1.75566716318264", "16.064177579207", "86.7807322029461", "296.564248779674",
              "637.333633378831", "793.826512519948", "440.413735824752"):
        den = f"({den} * a + {c})"
    frac = "(a + 0.65)"
    for k in (4, 3, 2, 1):
        frac = f"(a + {k} / {frac})"
    upper = (f"CASE WHEN a > 37 THEN 0 WHEN a < 7.07106781186547 THEN exp(-a * a / 2) * {num} / {den} "
             f"ELSE exp(-a * a / 2) / {frac} / sqrt(2 * pi()) END")
    return f"(SELECT CASE WHEN z > 0 THEN 1 - u ELSE u END FROM (SELECT z, {upper} AS u FROM " \
           f"(SELECT {x} AS z, abs({x}) AS a)))"


_SD = 0.7
_INPUT = f"""(
SELECT f.AnimalID, f.Location, f.Year, f.Week, f.FEC AS LastFEC, f.LastDose, a.Farm, a.Tag, a.Sex,
  a.AgeCat, coalesce(a.AvFEC, 250) AS AvFEC, a.ClinicalRisk, ln(f.FEC + 1) AS m,
  1 - {pnorm_sql(f'(ln(601) - ln(f.FEC + 1)) / {_SD}')} AS ThresholdProbability
FROM fec f JOIN animal a ON f.AnimalID = a.AnimalID AND f.Location = a.Location
  AND f.Year = a.Year WHERE a.AgeCat IS NOT NULL)"""

_PM = {"PM_Intercept": -0.4, "PM_AgeCatAge_0-5": 0.9, "PM_AgeCatAge_11-20": 0.1,
       "PM_AgeCatAge_21+": 0.3, "PM_AgeCatAge_6-10": 0.0, "PM_cdoy": -0.2, "PM_sdoy": 0.15,
       "PM_I(meanFEC/1000)": 1.2, "PM_SexDKF": 0.0, "PM_SexDKM": -0.1, "PM_SexMUPY": 0.25}
_SCORE = f"""(SELECT *, -0.4
  + CASE AgeCat WHEN 'Age_0-5' THEN 0.9 WHEN 'Age_11-20' THEN 0.1 WHEN 'Age_21+' THEN 0.3 ELSE 0 END
  - 0.2 * cos(Week * (2 * pi()) / 52) + 0.15 * sin(Week * (2 * pi()) / 52) + AvFEC * 1.2 / 1000
  + CASE Sex WHEN 'DKM' THEN -0.1 WHEN 'MUPY' THEN 0.25 ELSE 0 END AS DemographicProb
  FROM {_INPUT})"""
_RISK = f"""(SELECT *, CASE WHEN 1 / (1 + exp(-DemographicProb)) > 0.6 THEN 'Elevated' ELSE '' END
  AS DemographicRisk FROM {_SCORE})"""
_OVERALL = f"""(SELECT *, CASE WHEN ClinicalRisk = 'VeryHigh' THEN ClinicalRisk
  WHEN DemographicRisk = 'Elevated' THEN 'High' ELSE ClinicalRisk END AS OverallRisk FROM {_RISK})"""
_DECIDED = f"""(SELECT * EXCLUDE (LastDose), ThresholdProbability >= 0.35 AS ModelDose,
  LastFEC >= CASE OverallRisk WHEN 'VeryHigh' THEN 600 WHEN 'High' THEN 1000 ELSE 2000 END
    AS IndividDose,
  CASE WHEN LastDose > 52 THEN 'None' ELSE concat('Week ', CAST(Week + 4 - LastDose AS INT)) END
    AS LastDose FROM {_OVERALL})"""


def _input(spark, d):
    animal = fx.animal(spark, d).filter(F.col("AgeCat").isNotNull()).drop("Age", "Field")
    rows = fx.fec(spark, d).join(animal, ["AnimalID", "Location", "Year"])
    prob = X.threshold_probability(F.log1p("FEC"), 600.0, _SD)
    return rows.select("AnimalID", "Location", "Year", "Week", F.col("FEC").alias("LastFEC"),
                       "LastDose", "Farm", "Tag", "Sex", "AgeCat", "AvFEC", "ClinicalRisk",
                       prob.alias("ThresholdProbability"))


def _overall(spark, d):
    rows = fc.demographic_risk(_input(spark, d), _PM, fx.PM_THRESHOLD, 250.0)
    return rows.withColumn("OverallRisk", fc.overall_risk(
        F.col("ClinicalRisk"), F.col("DemographicRisk")))


@query("threshold_probability", f"""
SELECT AnimalID, Year, Week, {s6('ThresholdProbability')} AS p FROM {_INPUT}""", ["fec", "animal"])
def threshold_probability(spark, d):
    return _input(spark, d).select("AnimalID", "Year", "Week", r6("ThresholdProbability", "p"))


@query("demographic_risk", f"""
SELECT AnimalID, Year, Week, {s6('DemographicProb')} AS DemographicProb, DemographicRisk
FROM {_RISK}""", ["fec", "animal"])
def demographic_risk(spark, d):
    rows = fc.demographic_risk(_input(spark, d), _PM, fx.PM_THRESHOLD, 250.0)
    return round_doubles(rows.select("AnimalID", "Year", "Week", "DemographicProb",
                                     "DemographicRisk"))


@query("overall_risk", f"""
SELECT Year, ClinicalRisk, DemographicRisk, OverallRisk, count(*) AS n FROM {_OVERALL}
GROUP BY ALL""", ["fec", "animal"])
def overall_risk(spark, d):
    return _overall(spark, d).groupBy("Year", "ClinicalRisk", "DemographicRisk",
                                      "OverallRisk").agg(F.count(F.lit(1)).alias("n"))


@query("dose_decision", f"""
SELECT AnimalID, Year, Week, ModelDose, IndividDose, LastDose FROM {_DECIDED}""",
       ["fec", "animal"])
def dose_decision(spark, d):
    return fc.dose_decision(_overall(spark, d)).select(
        "AnimalID", "Year", "Week", "ModelDose", "IndividDose", "LastDose")


@query("prediction_report", f"""
SELECT Farm, Location, Year, Week, regexp_replace(AnimalID, '^.*_', '') AS Donkey, Tag,
  round_even(round(DemographicProb, 9), 2) + 0 AS DemographicProb, ClinicalRisk, DemographicRisk,
  OverallRisk, LastFEC, LastDose, LastFEC AS PredMean, {s6('ThresholdProbability')} AS Pthresh
FROM {_DECIDED}""", ["fec", "animal"])
def prediction_report(spark, d):
    rows = fc.dose_decision(_overall(spark, d)).withColumns({
        "PredictedAnimalMean": F.col("LastFEC"),
        "DemographicProb": F.round("DemographicProb", 9)})
    return round_doubles(fc.prediction_report(rows))


@query("prediction_band", f"""
SELECT AnimalID, Year, Week, LastFEC, t.Type, CASE t.Type WHEN 'MeanPred' THEN {s6('exp(m) - 1')}
  WHEN 'UPred' THEN {s6(f'exp(m + 1.96 * {_SD}) - 1')} ELSE {s6(f'exp(m - 1.96 * {_SD}) - 1')} END
  AS Value
FROM {_INPUT} CROSS JOIN (VALUES ('MeanPred'), ('UPred'), ('LPred')) AS t(Type)""",
       ["fec", "animal"])
def prediction_band(spark, d):
    rows = _input(spark, d).select("AnimalID", "Year", "Week", "LastFEC")
    return round_doubles(report.prediction_band(rows, _SD, "LastFEC"))
