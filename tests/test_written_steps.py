"""Steps of the fit that are done once, and in code that the JVM compiles."""

import re

import numpy as np
from conftest import MEDIUM
from pyspark.sql import functions as F

from herdcast.operators import group_model as gm
from herdcast.operators import mixed as mx
from herdcast.plans import forecast as fc
from herdcast.plans import train
from herdcast.queries import models


def test_individual_rows_are_predicted_once(spark, monkeypatch):
    calls, own = [], train.predicted_rows
    monkeypatch.setattr(train, "predicted_rows", lambda *a: calls.append(1) or own(*a))
    models.forget()
    means = models.location_week_means(spark, MEDIUM)
    rows = models.predict_group(spark, MEDIUM)
    assert means.agg(F.sum("NFEC")).first()[0] == rows.count() > 0
    assert len(calls) == 1


def test_predictions_of_many_terms_stay_compilable(spark, capsys):
    """HotSpot does not compile methods of 8000 bytes and more; the sums are those of the written-out formula."""
    n = 40
    design = {f"x{i}": F.log(F.col("v") + i) * F.when(F.col("v") != i, F.lit(1.0)) for i in range(1, n)}
    beta = [None if i == 3 else 0.1 * i - 1.0 for i in range(1, n)]
    folds = spark.createDataFrame([("F", 1, beta, 0.25, 0.5)], "Farm string, Year int, beta array<double>, farm_effect double, year_effect double")
    fit = mx.Fit(np.zeros(n - 1), 1.0, 0.0, 0.0, {}, 0.0)
    g = gm.GroupFit(design, fit, folds, {}, {}, None, ())
    df = spark.createDataFrame([("F", 1, 100.5), ("F", 1, 7.0), ("F", 2, 1.5), (None, 1, 1.5)], "Farm string, Year int, v double")
    out = gm.predict_excluded(df, g, "p", "q")
    want = sum((b or 0.0) * np.log(100.5 + i) for i, b in enumerate(beta, 1)) + 0.75
    got = {(r.Farm, r.Year, r.v): r.p for r in out.collect()}
    assert abs(got["F", 1, 100.5] - want) < 1e-9
    assert got["F", 1, 7.0] is None and got["F", 2, 1.5] is None and got[None, 1, 1.5] is None
    out.explain("codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))) < 8000


def test_a_week_asked_for_both_ways_is_one_row_of_the_frames(spark):
    fec = spark.createDataFrame([("A", "L", 1, w, 50.0, w == 14, float("inf")) for w in (12, 14, 16, 20)],
                                "AnimalID string, Location string, Year int, Week int, FEC double, Dose boolean, LastDose double")
    out = fc.forecast_features(fec, spark.createDataFrame([("L", 1, 16), ("L", 1, 20)], "Location string, Year int, Week int"))
    got = {(r.Target, r.Kind): r.LastDose for r in out.collect()}
    assert set(got) == {(8, "past"), (12, "past"), (16, "past"), (20, "past"), (20, "future"), (24, "future")}
    assert got[20, "past"] == 6 and got[20, "future"] == 6 and got[16, "past"] == 2
    asked = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate explode" in line]
    assert any("Kinds" in line for line in asked)


def test_sheet_weeks_are_sent_as_facts_not_as_wide_rows(spark, tmp_path):
    """Facts are dealt by sheet row once; no row of 108 columns is sent or sorted before the row is whole."""
    from herdcast import fixtures as fx
    tables = {"supplier": ([(1, 0, 50.0), (2, 0, -1.0)], "s_suppkey long, s_nationkey int, s_acctbal double"),
              "nation": ([(0, 0)], "n_nationkey int, n_regionkey int"), "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"),
              "lineitem": ([(1, "1995-03-07", 40.0, 7, "R"), (1, "1995-03-14", 20.0, 1, "N"), (2, "1995-03-07", 8.0, 1, "N"), (2, None, 8.0, 1, "N")],
                           "l_suppkey long, l_shipdate string, l_quantity double, l_linenumber int, l_returnflag string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    sheet = fx.wide_sheet(spark, str(tmp_path))
    plan = sheet._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[plan.index("[first(if"):plan.index("[partial_first(if")]
    got = {r["Name"]: {k: v for k, v in r.asDict().items() if k[0] in "FT" and k[1:].isdigit() and v is not None} for r in sheet.collect()}
    weeks = sorted({int(k[1:]) for cells in got.values() for k in cells})
    assert len(weeks) == 2 and got == {"S1": {f"F{weeks[0]}": "500.0", f"T{weeks[0]}": "FBZ", f"F{weeks[1]}": "250.0"}, "S2": {f"F{weeks[0]}": "100.0"}}
