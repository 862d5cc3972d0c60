"""Small simulated herds: farms of three hygiene levels, weekly sheets, daily weather."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

from herdcast.schema import ANIMAL, FEC, LOCATIONS, WEATHER


def monday(year: int, week: int) -> dt.date:
    first = dt.date(year, 1, 1)
    first += dt.timedelta(days=(-first.weekday()) % 7)
    return first + dt.timedelta(days=(week - 1) * 7)


def herd(spark, years=(2001, 2002), per_location=(14, 24), weeks=range(12, 49, 4), seed=1):
    """Locations, Animal, FEC and Weather frames (three farms of three fields)."""
    rng = np.random.default_rng(seed)
    loc, ani, fec = [], [], []
    factor = {"None": 1.0, "Automated": 0.8, "Manual": 0.6}
    for farm in ("North", "South", "West"):
        for i, hyg in enumerate(("None", "Automated", "Manual")):
            place = f"{farm}_Field{i}"
            n = int(rng.integers(*per_location))
            sex = rng.choice(["DKF", "DKM", "MUPY"], n)
            age = rng.integers(1, 25, n)
            level = rng.normal(0, 0.4, n)
            for year in years:
                loc.append((year, farm, f"Field{i}", place, hyg, 50.0))
                shift = rng.normal(0, 0.2)
                for a in range(n):
                    name = f"{farm}_A{i}x{a}"
                    cat = ("Age_0-5" if age[a] <= 5.5 else "Age_6-10" if age[a] <= 10.5
                           else "Age_11-20" if age[a] <= 20.5 else "Age_21+")
                    ani.append((year, farm, place, f"Field{i}", name, f"T{a}", str(sex[a]),
                                float(age[a] + year - years[0]), cat,
                                float(rng.integers(0, 900)) if rng.random() < .8 else None,
                                "Normal"))
                    last = None
                    for w in weeks:
                        m = monday(year, w)
                        mean = 8 * factor[hyg] * np.exp(level[a] + shift + 0.3 * np.sin(w / 8))
                        count = rng.negative_binomial(1, 1 / (1 + mean))
                        gap = float("inf") if last is None else (m - last).days / 7
                        dose = bool(count * 50 >= 1500)
                        fec.append((name, place, year, w, count * 50.0, float(count), dose,
                                    "MOX" if dose else None, m, gap))
                        if dose:
                            last = m
    days = pd.date_range(f"{min(years) - 1}-01-01", f"{max(years)}-12-31")
    temp = 10 + 8 * np.sin((days.dayofyear - 110) / 58) + rng.normal(0, 2, len(days))
    wx = [(d.date(), d.year, d.month, d.day, float(t - 6), float(t), float(t + 6),
           float(rng.uniform(60, 90)), float(rng.uniform(5, 12))) for d, t in zip(days, temp)]
    return (spark.createDataFrame(loc, LOCATIONS), spark.createDataFrame(ani, ANIMAL),
            spark.createDataFrame(fec, FEC), spark.createDataFrame(wx, WEATHER))
