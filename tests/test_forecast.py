"""Fit and forecast on simulated herds, end to end."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from simulate import herd

from herdcast.operators import features as ft
from herdcast.operators import group_model as gm
from herdcast.plans import forecast as fc
from herdcast.plans import report, train
from herdcast.schema import PM_TERMS, ModelSpec

SPEC = ModelSpec(terms=("DoseProp4", "DoseProp8", "DoseProp12", "Temp_avg_8", "Temp_avg_8^2/10",
                        "sdoy", "cdoy"), random_year=False)
PM = dict(zip(PM_TERMS, (-0.4, 0.9, 0.1, 0.3, 0.0, -0.2, 0.15, 1.2, 0.0, -0.1, 0.25)))


@pytest.fixture(scope="module")
def world(spark):
    loc, ani, fec, wx = (df.persist() for df in herd(spark, years=(2001, 2002, 2003)))
    t = train.HerdTables(loc, ani, fec, wx)
    return t, train.fit_models(t, SPEC, validate=True)


def test_chain_converges_and_explains(world):
    _, m = world
    assert m.chain.converged
    assert 0.3 < m.dispersion.residual_sd < 2.5       # simulated with a dispersion of one
    assert m.chain.individual[4]["fec4wk"] > 0        # animals differ, so history helps
    assert len(m.chain.convergence) == len(report.convergence_table(m.rows.sparkSession, m).collect())


def test_features_match_plain_python(world):
    t, m = world
    facts = fc.limit_to_weather(t.fec, m.rolling)
    samplings = ft.sampling_events(facts, t.animal, t.locations)
    by = {}
    for r in facts.collect():
        by.setdefault((r.AnimalID, r.Year), {})[r.Week] = r
    got = fc.forecast_features(facts, samplings).collect()
    assert len(got) > 1000
    for r in got[::7]:
        mine = {w: x for w, x in by[(r.AnimalID, r.Year)].items() if r.Target - 24 <= w <= r.Target}

        def mean(a, b):
            v = [math.log1p(x.FEC) for w, x in mine.items() if a <= r.Target - w <= b]
            return sum(v) / len(v) if v else None
        for name, (a, b) in (("fec4wk", (3, 5)), ("fec8wk", (7, 9)), ("fec12wk", (11, 13))):
            want = mean(a, b)
            assert (r[name] is None) == (want is None)
            assert want is None or r[name] == pytest.approx(want)
        cut = r.Target - (4 if r.Kind == fc.FUTURE else 0)
        before = [x for w, x in mine.items() if w < cut]
        last = max([max(before, key=lambda x: x.Week)], key=lambda x: x.Week) if before else None
        weeks = [x.Week for x in before if x.Dose] + ([last.Week - last.LastDose] if last else [])
        assert r.LastDose == (r.Target - max(weeks) if weeks else math.inf)
        seen = mine.get(r.Target)
        assert r.ObservedFEC == (seen.FEC if seen else None)


def test_predictions_are_whole_and_reproducible(world):
    t, m = world
    raw, decided = fc.get_predictions(t.fec, t.animal, t.locations, m, PM, 0.6)
    raw = raw.persist()
    assert raw.groupBy("Year", "Location", "Week", "AnimalID").count().filter("count > 1").isEmpty()
    facts = fc.limit_to_weather(t.fec, m.rolling)
    events = ft.sampling_events(facts, t.animal, t.locations)
    assert raw.count() == events.agg(F.sum("TotalAnimals")).first()[0]
    p = raw.select("ThresholdProbability", "PredictedAnimalMean").toPandas()
    assert p["ThresholdProbability"].between(0, 1).all() and p.notna().all().all()
    order = p.sort_values("PredictedAnimalMean")["ThresholdProbability"].to_numpy()
    assert (np.diff(order) >= -0.0101).all()          # a higher mean is never less likely
    every = fc.get_predictions(t.fec, t.animal, t.locations, m, PM, 0.6, validate_only=False)[1]
    assert every.count() == raw.count() > decided.count() > 0
    assert decided.filter("ModelDose IS NULL OR IndividDose IS NULL OR OverallRisk IS NULL").isEmpty()
    assert "Donkey" in fc.prediction_report(decided).columns


def test_excluded_prediction_is_the_fold_times_the_row(world):
    t, m = world
    rows = train.predicted_rows(t, m.group, m.rolling, m.options, m.spec)
    r = rows.filter("LastDose <= 4").first()
    fold = m.group.folds.filter((F.col("Farm") == r.Farm) & (F.col("Year") == r.Year)).first()
    b = dict(zip(m.group.design, fold["beta"]))
    assert r.GroupPredictionIncTx - r.GroupPredictionNoTx == pytest.approx(
        (b["DoseProp4"] + b["DoseProp12"]) * math.log(0.05))


def test_reports(spark, world):
    _, m = world
    table = report.coefficient_table(spark, m, PM, 0.6, layout=True).orderBy("ord").collect()
    names = [r.groupcoefnames for r in table]
    assert names[0] == "Group Coefficients:" and names[2] == "GroupIntercept" and names[-1] == ""
    assert [n for n in names if n.startswith("PM_")] == [*PM_TERMS, "PM_threshold"]
    assert "lastYearMeanFEC_8wk" in names and "I(Temp_frost_20^2/10)" in names
    with pytest.raises(ValueError):
        report.coefficient_table(spark, m, dict(reversed(PM.items())), 0.6)
    seen = report.observed_vs_predicted(m.group, m.group_data, m.rolling)
    assert seen.filter("N IS NOT NULL").count() == m.group_data.count()
    assert seen.filter("Predicted IS NOT NULL").groupBy("Year", "Location", "Farm").count().count() == 27
    grid = gm.prediction_grid(m.group, m.group_data, None)
    assert grid.count() == 3 * 3 * 3 * 53
    same = report.coefficient_compare(*[report.coefficient_table(spark, m, PM, 0.6)] * 2)
    assert same.filter("difference <> 0").isEmpty()
    wide = report.location_year_effects(m.group_data, m)
    assert wide.columns == ["Location", "2001", "2002", "2003"] and wide.count() == 9
    band = report.prediction_band(m.group_data.select(F.lit(100.0).alias("PredictedAnimalMean")).limit(1), 0.5)
    got = {r.Type: r.Value for r in band.collect()}
    assert got["LPred"] < got["MeanPred"] < got["UPred"]


def test_comparison_needs_three_years_and_tables_are_checked(world):
    t, _ = world
    with pytest.raises(ValueError):
        train.compare_without_last_year(t.years((2001, 2002)), SPEC)
    with pytest.raises(ValueError):
        train.fit_models(t.years((2001, 2003)), SPEC, validate=True)


def test_overall_risk_rule(spark):
    df = spark.createDataFrame([("VeryHigh", "Elevated"), ("Normal", "Elevated"), ("High", "")], "c string, d string")
    risk = [r[0] for r in df.select(fc.overall_risk(F.col("c"), F.col("d"))).collect()]
    assert risk == ["VeryHigh", "High", "High"]
    old = [r[0] for r in df.select(fc.overall_risk(F.col("c"), F.col("d"), True)).collect()]
    assert old == ["High", "High", "High"]
