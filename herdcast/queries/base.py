"""Registry of queries, and the shared SQL views their oracle statements build on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herdcast.schema import WEATHER_LAGS

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: Iterable[str] = ()) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = with_views(sql, views)
        return fn
    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    from herdcast.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/herdcast/{what}-{uuid.uuid4().hex}"


def r6(col: str | Column, name: str | None = None) -> Column:
    """Rounded to six digits (sums of doubles depend on their order beyond that)."""
    c = F.col(col) if isinstance(col, str) else col
    out = F.round(c, 6)
    return out.alias(name or col) if (name or isinstance(col, str)) else out


def s6(text: str) -> str:
    return f"(round({text}, 6) + 0)"


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


# ------------------------------------------------------------------ shared SQL views
def wk(d: str) -> str:
    return f"CAST(strftime({d}, '%W') AS INT)"


def age_band(a: str) -> str:
    return (f"CASE WHEN {a} > -1 AND {a} <= 5.5 THEN 'Age_0-5' WHEN {a} > 5.5 AND {a} <= 10.5 "
            f"THEN 'Age_6-10' WHEN {a} > 10.5 AND {a} <= 20.5 THEN 'Age_11-20' "
            f"WHEN {a} > 20.5 AND {a} <= 100 THEN 'Age_21+' END")


def dose_cat(d: str) -> str:
    return (f"CASE WHEN {d} > 0.5 AND {d} <= 4.5 THEN '1-4' WHEN {d} > 4.5 AND {d} <= 8.5 THEN "
            f"'5-8' WHEN {d} > 8.5 AND {d} <= 12.5 THEN '9-12' WHEN {d} > 12.5 THEN '>12' END")


def abs_hum(t: str, rh: str) -> str:
    return f"6.112 * exp({t} * 17.67 / ({t} + 243.5)) * {rh} * 2.1674 / ({t} + 273.15)"


def rel_hum(t: str, d: str) -> str:
    return f"exp({d} * 17.625 / ({d} + 243.04)) / exp({t} * 17.625 / ({t} + 243.04)) * 100"


_FARM = "concat('FARM_', CAST(r_regionkey % 2 AS VARCHAR))"
_LOC = f"concat({_FARM}, '_', replace(r_name, ' ', ''))"
_PLACE = ("supplier JOIN nation ON s_nationkey = n_nationkey "
          "JOIN region ON n_regionkey = r_regionkey")


def weather_view(where: str = "TRUE") -> str:
    return f"""
    SELECT D AS Date, CAST(year(D) AS INT) AS Year, CAST(month(D) AS INT) AS Month,
      CAST(day(D) AS INT) AS Day, ta - 6 AS Temp_low, ta AS Temp_avg, ta + 6 AS Temp_high,
      rh AS Rel_Humidity_avg, {abs_hum('ta', 'rh')} AS Abs_Humidity_avg
    FROM (SELECT CAST(l_shipdate AS DATE) AS D,
        round(10 - cos(dayofyear(CAST(l_shipdate AS DATE)) * (2 * pi()) / 365.25) * 8
              + (avg(l_quantity) - 25) / 2, 2) AS ta,
        round(60 + avg(l_linenumber) * 4, 2) AS rh
      FROM lineitem WHERE {where} GROUP BY 1)"""


def rolling_view(source: str = "weather", lags: Iterable[int] = WEATHER_LAGS) -> str:
    cols = []
    for k in lags:
        band = f"FILTER (WHERE date_diff('day', w.Date, m.Monday) BETWEEN {k * 7 + 1} AND {(k + 4) * 7})"
        for out, agg, src in (("Temp_avg", "avg(w.Temp_avg)", "Temp_avg"),
                              ("Temp_low", "min(w.Temp_low)", "Temp_low"),
                              ("Temp_frost", None, "Temp_low"),
                              ("RelHumid", "avg(w.Rel_Humidity_avg)", "Rel_Humidity_avg"),
                              ("AbsHumid", "avg(w.Abs_Humidity_avg)", "Abs_Humidity_avg")):
            value = (f"{agg} {band}" if agg else
                     f"CAST(sum(CASE WHEN w.Temp_low < 0 THEN 1 ELSE 0 END) {band} AS DOUBLE)")
            cols.append(f"CASE WHEN count(w.{src}) {band} = 28 THEN {value} END AS {out}_{k}")
    far = (max(lags) + 4) * 7
    return f"""
    SELECT m.Year, m.Week, m.Monday, {', '.join(cols)}
    FROM (SELECT DISTINCT Year, {wk('Date')} AS Week,
            CAST(date_trunc('week', Date) AS DATE) AS Monday FROM {source}) m
    LEFT JOIN {source} w ON w.Date >= m.Monday - {far} AND w.Date < m.Monday
    GROUP BY m.Year, m.Week, m.Monday"""


MIN_WEEK, MAX_WEEK = 12, 48
_SEASON = f"Week BETWEEN {MIN_WEEK} AND {MAX_WEEK} AND Location IS NOT NULL AND FEC IS NOT NULL"


def dose_prop(k: int) -> str:
    d = f"DosedWithin{k}"
    return f"ln((TotalAnimals - {d}) / TotalAnimals + 0.05 * {d} / TotalAnimals)"


VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "years": ("SELECT DISTINCT CAST(year(date_trunc('week', l_shipdate)) AS INT) AS Year FROM lineitem", ()),
    "locations": (f"""
    SELECT Year, {_FARM} AS Farm, r_name AS Field, {_LOC} AS Location,
      CASE r_regionkey % 3 WHEN 0 THEN 'None' WHEN 1 THEN 'Automated' ELSE 'Manual' END AS Hygiene,
      CAST(50 AS DOUBLE) AS Sensitivity FROM region CROSS JOIN years""", ("years",)),
    "animal": (f"""
    SELECT Year, {_FARM} AS Farm, {_LOC} AS Location, r_name AS Field,
      concat({_FARM}, '_S', CAST(s_suppkey AS VARCHAR)) AS AnimalID,
      concat('T', CAST(s_suppkey AS VARCHAR)) AS Tag,
      CASE s_suppkey % 3 WHEN 0 THEN 'DKF' WHEN 1 THEN 'DKM' ELSE 'MUPY' END AS Sex,
      CAST(s_suppkey % 30 + (Year - 1995) AS DOUBLE) AS Age,
      {age_band('(s_suppkey % 30 + (Year - 1995))')} AS AgeCat,
      CASE WHEN s_acctbal > 0 THEN s_acctbal / 10 END AS AvFEC,
      CASE WHEN s_suppkey % 20 = 0 THEN 'VeryHigh' WHEN s_suppkey % 7 = 0 THEN 'High'
           ELSE 'Normal' END AS ClinicalRisk
    FROM {_PLACE} CROSS JOIN years""", ("years",)),
    "counts": (f"""
    SELECT concat({_FARM}, '_S', CAST(s_suppkey AS VARCHAR)) AS AnimalID, {_LOC} AS Location,
      CAST(year(M) AS INT) AS Year, {wk('M')} AS Week, 50 * floor(q / 4) AS FEC,
      floor(q / 4) AS Count, Dose,
      CASE WHEN Dose THEN ['MOX','FBZ','IVM','PYR'][s_suppkey % 4 + 1] END AS DoseText, M AS Monday
    FROM (SELECT l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS M,
            avg(l_quantity) AS q,
            bool_or(l_linenumber = 7 AND l_returnflag = 'R' AND l_quantity > 25) AS Dose
          FROM lineitem GROUP BY 1, 2)
    JOIN ({'SELECT * FROM ' + _PLACE}) ON l_suppkey = s_suppkey""", ()),
    "fec": ("""
    SELECT *, coalesce(date_diff('day', max(CASE WHEN Dose THEN Monday END) OVER (
        PARTITION BY AnimalID, Year ORDER BY Monday
        RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING), Monday) / 7.0,
        CAST('Infinity' AS DOUBLE)) AS LastDose FROM counts""", ("counts",)),
    "weather": (weather_view(), ()),
    "site_days": (f"""
    SELECT Site, Date, ta - 6 AS Temp_low, ta AS Temp_avg, ta + 6 AS Temp_high, rh AS Rel_Humidity_avg,
      {abs_hum('ta', 'rh')} AS Abs_Humidity_avg
    FROM (SELECT s_nationkey AS Site, CAST(l_shipdate AS DATE) AS Date, round(avg(l_quantity) - 15, 2) AS ta,
            round(60 + avg(l_linenumber) * 4, 2) AS rh
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)""", ()),
    "site_calendar": ("""
    SELECT Site, CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date
    FROM site_days GROUP BY Site""", ("site_days",)),
    "weather_f": (weather_view("l_linestatus = 'F'"), ()),
    "weather_o": (weather_view("l_linestatus = 'O'"), ()),
    "rolling": (rolling_view(), ("weather",)),
    "raw_animals": (f"""
    SELECT {_FARM} AS Farm, Year, concat('S ', CAST(s_suppkey AS VARCHAR)) AS Name,
      concat('T', CAST(s_suppkey AS VARCHAR)) AS Tag,
      CASE WHEN s_suppkey % 41 = 0 THEN 'XX' WHEN s_suppkey % 3 = 0 THEN 'dkf'
           WHEN s_suppkey % 3 = 1 THEN ' dkg' ELSE 'Hy F' END AS Sex,
      CASE WHEN s_suppkey % 43 = 0 THEN 'old' WHEN s_suppkey % 30 + (Year - 1995) < 1 THEN '<1'
           ELSE CAST(s_suppkey % 30 + (Year - 1995) AS VARCHAR) END AS Age,
      CASE WHEN s_suppkey % 47 = 0 THEN 'Back Field' ELSE r_name END AS Location,
      CASE WHEN s_suppkey % 53 = 0 THEN 'severe' WHEN s_suppkey % 20 = 0 THEN 'Very High'
           WHEN s_suppkey % 7 = 0 THEN ' high' WHEN s_suppkey % 2 = 0 THEN 'Normal' END
        AS ClinicalRisk,
      CASE WHEN s_acctbal > 0 THEN CAST(floor(s_acctbal * 10) / 100 AS VARCHAR) ELSE '' END
        AS AvFEC
    FROM {_PLACE} CROSS JOIN years""", ("years",)),
    "group_week": (f"""
    SELECT Location, Year, Week, Monday, avg(ln(FEC + 1)) AS meanLogFEC, count(*) AS TotalFEC,
      count_if(LastDose <= 4) AS DosedWithin4,
      count_if(LastDose <= 8) - count_if(LastDose <= 4) AS DosedWithin8,
      count_if(LastDose <= 12) - count_if(LastDose <= 8) AS DosedWithin12
    FROM fec WHERE {_SEASON} GROUP BY Location, Year, Week, Monday""", ("fec",)),
    "loc_summary": ("""
    SELECT a.Farm, a.Location, a.Year, l.Hygiene, l.Sensitivity, avg(a.Age) AS MeanAge,
      count(*) AS TotalAnimals
    FROM animal a LEFT JOIN locations l ON a.Farm = l.Farm AND a.Location = l.Location
      AND a.Year = l.Year
    WHERE a.Location IS NOT NULL GROUP BY ALL""", ("animal", "locations")),
    "group_rows": ("""
    SELECT g.*, s.Farm, s.Hygiene, s.Sensitivity, s.MeanAge, s.TotalAnimals,
      sin(Week * (2 * pi()) / 52) AS sdoy, cos(Week * (2 * pi()) / 52) AS cdoy
    FROM group_week g LEFT JOIN loc_summary s ON g.Location = s.Location AND g.Year = s.Year""",
                   ("group_week", "loc_summary")),
    "ind_rows": (f"""
    SELECT f.*, a.Farm, a.Tag, a.Sex, a.Age, a.AgeCat, a.AvFEC, a.ClinicalRisk, s.Hygiene,
      s.Sensitivity, s.MeanAge, s.TotalAnimals, sin(f.Week * (2 * pi()) / 52) AS sdoy,
      cos(f.Week * (2 * pi()) / 52) AS cdoy,
      CASE WHEN LastDose <= 4 THEN ln(0.05) ELSE 0 END AS DoseProp4,
      CASE WHEN LastDose <= 8 AND NOT LastDose <= 4 THEN ln(0.05) ELSE 0 END AS DoseProp8,
      CASE WHEN LastDose <= 12 AND NOT (LastDose <= 8 AND NOT LastDose <= 4) THEN ln(0.05)
           ELSE 0 END AS DoseProp12,
      {dose_cat('LastDose')} AS LastDoseCat
    FROM (SELECT * FROM fec WHERE {_SEASON}) f
    LEFT JOIN animal a ON f.AnimalID = a.AnimalID AND f.Location = a.Location AND f.Year = a.Year
    LEFT JOIN loc_summary s ON f.Location = s.Location AND f.Year = s.Year AND a.Farm = s.Farm""",
                 ("fec", "animal", "loc_summary")),
}

VIEWS["full_rows"] = ("""
    SELECT g.*, r.* EXCLUDE (Year, Week, Monday) FROM group_rows g LEFT JOIN rolling r
    ON g.Year = r.Year AND g.Week = r.Week AND g.Monday = r.Monday""", ("group_rows", "rolling"))


def _band(lo: int, hi: int) -> str:
    return f"BETWEEN INTERVAL {7 * hi} DAY PRECEDING AND INTERVAL {7 * lo} DAY PRECEDING"


def lag_mean_sql(lo: int, hi: int, part: str = "AnimalID") -> str:
    return f"avg(ln(FEC + 1)) OVER (PARTITION BY {part} ORDER BY Monday RANGE {_band(lo, hi)})"


def lag_dose_sql(lo: int, hi: int, part: str = "AnimalID") -> str:
    return (f"coalesce(bool_or(Dose) OVER (PARTITION BY {part} ORDER BY Monday "
            f"RANGE {_band(lo, hi)}), FALSE)")


VIEWS["ind_lags"] = (
    "SELECT *, " + ", ".join(
        [f"{lag_mean_sql(a, b)} AS {n}" for n, a, b in
         (("fec4wk", 3, 5), ("fec8wk", 7, 9), ("fec12wk", 11, 13))]
        + [f"{lag_dose_sql(a, b)} AS dose{a}_{b}wk" for a, b in
           ((5, 12), (5, 16), (9, 16), (9, 20), (13, 20), (13, 24))]) + " FROM ind_rows",
    ("ind_rows",))
VIEWS["year_mean"] = ("""
    SELECT AnimalID, Location, Farm, Year + 1 AS Year, ln(avg(FEC) + 1) AS lastYearMeanFEC
    FROM ind_rows GROUP BY AnimalID, Location, Farm, Year""", ("ind_rows",))
VIEWS["history"] = ("""
    SELECT i.*, y.lastYearMeanFEC, ln(FEC + 1) AS Obs,
      CASE WHEN fec4wk IS NOT NULL THEN 4 WHEN fec8wk IS NOT NULL THEN 8
           WHEN fec12wk IS NOT NULL THEN 12 ELSE 0 END AS Tier
    FROM ind_lags i JOIN year_mean y ON i.AnimalID = y.AnimalID AND i.Location = y.Location
      AND i.Farm = y.Farm AND i.Year = y.Year
    WHERE Sex IS NOT NULL AND AgeCat IS NOT NULL""", ("ind_lags", "year_mean"))


def with_views(body: str, views: Iterable[str]) -> str:
    """Prefix ``body`` with the views it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in VIEWS[name][1]:
            visit(dep)
        order.append(name)
    for v in views:
        visit(v)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in order)
    return f"WITH {head}\n{body}"
