"""Data-quality checks, each run where the given tables do hold violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from herdcast import fixtures as fx
from herdcast.functions import calendar as cal
from herdcast.functions import expr as X
from herdcast.operators import checks as C
from herdcast.operators import features as ft
from herdcast.operators import lags as L
from herdcast.queries.base import query, wk
from herdcast.schema import (DRUG_CODES, HYGIENE_LEVELS, RISK_LEVELS, SEX_CODES,
                             SHEET_FIRST_COLUMNS)

_CODES = ", ".join(f"'{c}'" for c in SEX_CODES)


@query("check_unique_key", """
SELECT Location, Monday, count(*) AS n FROM counts GROUP BY 1, 2 HAVING count(*) > 1""",
       ["counts"])
def check_unique_key(spark, d):
    return C.unique_key(fx.weekly_counts(spark, d), ("Location", "Monday"))


@query("check_required_columns", """
SELECT p.problem, CAST(count(*) AS BIGINT) AS rows FROM (VALUES ('missing column Age'),
  ('duplicate column Tag')) AS p(problem) CROSS JOIN raw_animals GROUP BY 1""", ["raw_animals"])
def check_required_columns(spark, d):
    sheet = fx.raw_animals(spark, d)
    found = [c for c in sheet.columns if c not in ("Farm", "Year", "Age")] + ["Tag"]
    problems = C.required_columns(found, SHEET_FIRST_COLUMNS, in_order=True)
    n = sheet.agg(F.count(F.lit(1)).alias("rows"))
    return n.select(F.explode(F.array(*[F.lit(p) for p in problems])).alias("problem"), "rows")


@query("check_domain", f"""
SELECT 'Sex' AS col, Sex AS value, count(*) AS n FROM raw_animals
WHERE upper(replace(Sex, ' ', '')) NOT IN ({_CODES}) GROUP BY 2
UNION ALL SELECT 'ClinicalRisk', ClinicalRisk, count(*) FROM raw_animals
WHERE lower(replace(ClinicalRisk, ' ', '')) NOT IN ('normal', 'high', 'veryhigh') GROUP BY 2
UNION ALL SELECT 'Hygiene', p_brand, count(*) FROM part
WHERE p_brand NOT IN ('None', 'Automated', 'Manual') GROUP BY 2""", ["raw_animals"])
def check_domain(spark, d):
    raw = fx.raw_animals(spark, d)
    parts = fx.table(spark, d, "part")
    found = {
        "Sex": C.domain(raw, "Sex", SEX_CODES, F.upper(F.regexp_replace("Sex", " ", ""))),
        "ClinicalRisk": C.domain(raw, "ClinicalRisk", RISK_LEVELS,
                                 X.recode_risk(F.col("ClinicalRisk"))),
        "Hygiene": C.domain(parts, "p_brand", HYGIENE_LEVELS)}
    out = None
    for name, df in found.items():
        part = df.select(F.lit(name).alias("col"), "value", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("check_numeric_parse", """
SELECT 'Age' AS col, Age AS value, count(*) AS n FROM raw_animals
WHERE Age <> '<1' AND try_cast(Age AS DOUBLE) IS NULL GROUP BY 2
UNION ALL SELECT 'Name', Name, count(*) FROM raw_animals
WHERE try_cast(Name AS DOUBLE) IS NULL GROUP BY 2
UNION ALL SELECT 'AvFEC', AvFEC, count(*) FROM raw_animals
WHERE try_cast(AvFEC AS DOUBLE) IS NULL AND AvFEC <> '' GROUP BY 2""", ["raw_animals"])
def check_numeric_parse(spark, d):
    raw = fx.raw_animals(spark, d)
    parts = (("Age", C.numeric_parse(raw, "Age", age=True)),
             ("Name", C.numeric_parse(raw, "Name")),
             ("AvFEC", C.numeric_parse(raw, "AvFEC", blank_ok=True)))
    out = None
    for name, df in parts:
        part = df.select(F.lit(name).alias("col"), "value", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("check_not_null", """
SELECT 'ClinicalRisk' AS "column", count_if(ClinicalRisk IS NULL) AS n FROM raw_animals
HAVING count_if(ClinicalRisk IS NULL) > 0""", ["raw_animals"])
def check_not_null(spark, d):
    return C.not_null(fx.raw_animals(spark, d), ("Name", "Sex", "Age", "Location", "ClinicalRisk"))


@query("check_range", """
SELECT Week AS value, count(*) AS n FROM counts WHERE NOT Week BETWEEN 12 AND 48 GROUP BY 1""",
       ["counts"])
def check_range(spark, d):
    return C.in_range(fx.weekly_counts(spark, d), "Week", 12, 48)


@query("check_contiguous_dates", """
SELECT Site, CAST(Date + 1 AS DATE) AS FirstMissing, CAST(nxt - Date - 1 AS INT) AS MissingDays
FROM (SELECT Site, Date, lead(Date) OVER (PARTITION BY Site ORDER BY Date) AS nxt FROM site_days)
WHERE nxt - Date > 1""", ["site_days"])
def check_contiguous_dates(spark, d):
    return C.contiguous_dates(fx.site_days(spark, d), by=("Site",))


@query("check_week_shape", f"""
SELECT Site, Year, Week, days, weekdays FROM (
  SELECT Site, Year, Week, days, weekdays, min(Week) OVER (PARTITION BY Site, Year) AS lo,
    max(Week) OVER (PARTITION BY Site, Year) AS hi
  FROM (SELECT Site, CAST(year(Date) AS INT) AS Year, {wk('Date')} AS Week, count(*) AS days,
          count(DISTINCT isodow(Date)) AS weekdays FROM site_days GROUP BY 1, 2, 3))
WHERE Week > lo AND Week < hi AND (days <> 7 OR weekdays <> 7)""", ["site_days"])
def check_week_shape(spark, d):
    days = fx.site_days(spark, d).withColumns({"Year": F.year("Date"), "Week": cal.week_w(F.col("Date"))})
    return C.week_shape(days, by=("Site", "Year"))


def _typed_in_count(spark, d):
    """Long sheet cells in which treatment texts were typed under the count columns."""
    f = fx.weekly_counts(spark, d)
    return f.select("AnimalID", "Location", "Year",
                    F.concat(F.lit("F"), F.col("Week").cast("string")).alias("Observation"),
                    F.coalesce(F.concat(F.lit("given "), "DoseText"),
                               F.col("FEC").cast("string")).alias("Value"))


@query("check_text_in_count", """
SELECT AnimalID, Location, Year, concat('F', Week) AS Observation,
  concat('given ', DoseText) AS Value FROM counts WHERE Dose""", ["counts"])
def check_text_in_count(spark, d):
    return C.text_in_count(_typed_in_count(spark, d), DRUG_CODES)


@query("check_one_obs_per_week", """
SELECT s AS AnimalID, y AS Year, w AS Week, count(q) AS numfec, count_if(t) AS numtx,
  count(CASE WHEN t THEN r END) AS numtext
FROM (SELECT CAST(l_suppkey AS VARCHAR) AS s, CAST(year(l_shipdate) AS INT) AS y,
        CAST(strftime(l_shipdate, '%W') AS INT) AS w, l_quantity AS q,
        l_returnflag = 'R' AS t, l_returnflag AS r FROM lineitem)
GROUP BY 1, 2, 3 HAVING count(q) > 1 OR count_if(t) > 1""")
def check_one_obs_per_week(spark, d):
    # raw rows before the weekly fold: several readings of one animal in one week
    day = fx.ship_date()
    parsed = fx.table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("AnimalID"), F.year(day).alias("Year"),
        cal.week_w(day).alias("Week"), F.col("l_quantity").alias("FEC"),
        (F.col("l_returnflag") == "R").alias("Dose"),
        F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).alias("DoseText"))
    return C.one_obs_per_week(parsed)


@query("check_unknown_location", """
SELECT Farm, Year, Location AS Field, count(*) AS n FROM raw_animals
WHERE Location = 'Back Field' GROUP BY ALL""", ["raw_animals"])
def check_unknown_location(spark, d):
    return C.unknown_location(fx.raw_animals(spark, d), fx.locations(spark, d))


@query("check_year_coverage", """
SELECT Year, 'Orders' AS missing_from FROM (SELECT DISTINCT Year FROM counts)
WHERE Year NOT IN (SELECT year(o_orderdate) + 1 FROM orders)
UNION ALL SELECT Year, 'Weather' FROM (SELECT DISTINCT Year FROM counts)
WHERE Year NOT IN (SELECT Year FROM weather)""", ["counts", "weather"])
def check_year_coverage(spark, d):
    orders = fx.table(spark, d, "orders").select((F.year("o_orderdate") + 1).alias("Year"))
    return C.year_coverage(fx.weekly_counts(spark, d),
                           {"Orders": orders, "Weather": fx.weather(spark, d)})


@query("check_year_span", """
SELECT min(Year) AS first_year, max(Year) AS last_year, count(DISTINCT Year) AS n_years,
  count(DISTINCT Year) >= 2 AND max(Year) - min(Year) + 1 = count(DISTINCT Year) AS ok
FROM counts""", ["counts"])
def check_year_span(spark, d):
    return C.year_span(fx.weekly_counts(spark, d))


@query("check_group_invariants", """
SELECT Location, Year, Week, TotalFEC, CAST(TotalAnimals // 2 AS BIGINT) AS TotalAnimals
FROM group_rows WHERE TotalAnimals // 2 < TotalFEC
  OR TotalAnimals // 2 < DosedWithin4 + DosedWithin8 + DosedWithin12""", ["group_rows"])
def check_group_invariants(spark, d):
    # the real frame holds no violation (tested); halving the herd size plants them
    rows = ft.group_rows(fx.fec(spark, d), fx.animal(spark, d), fx.locations(spark, d))
    halved = rows.withColumn("TotalAnimals", F.floor(F.col("TotalAnimals") / 2))
    return C.group_invariants(halved).select("Location", "Year", "Week", "TotalFEC",
                                             "TotalAnimals")


_FLAGS = ("dose5_12wk", "dose9_16wk", "dose13_20wk")


@query("check_dosing_leverage", " UNION ALL ".join(
    f"SELECT '{c}' AS flag, count_if({c}) AS n_true, count_if(NOT {c}) AS n_false, "
    f"count_if({c}) >= 5 AND count_if(NOT {c}) >= 5 AS ok FROM ind_lags" for c in _FLAGS),
       ["ind_lags"])
def check_dosing_leverage(spark, d):
    rows = ft.filter_season(fx.fec(spark, d))
    return C.dosing_leverage(L.history_lags(rows, mean=False), _FLAGS)


@query("filter_years_last_n", """
SELECT Year, count(*) AS n FROM counts WHERE Year BETWEEN 1996 AND 1999 GROUP BY 1""", ["counts"])
def filter_years_last_n(spark, d):
    return (ft.filter_years(fx.weekly_counts(spark, d), as_of_year=2000, n_years=4)
            .groupBy("Year").agg(F.count(F.lit(1)).alias("n")))


@query("filter_season", """
SELECT AnimalID, Location, Monday, FEC FROM counts WHERE Week BETWEEN 12 AND 48""", ["counts"])
def filter_season(spark, d):
    return ft.filter_season(fx.weekly_counts(spark, d)).select(
        "AnimalID", "Location", "Monday", "FEC")


@query("coverage_check", """
SELECT min(Date) AS first_day, max(Date) AS last_day,
  min(Date) <= DATE '1996-01-01' - 259 AS start_ok, max(Date) >= DATE '2001-06-01' - 7 AS end_ok
FROM weather""", ["weather"])
def coverage_check(spark, d):
    return C.coverage_dates(fx.weather(spark, d), 1996, "2001-06-01")


@query("rolling_coverage", f"""
SELECT m.Year, m.Week, m.Monday, count(w.Date) AS days_present,
  count(w.Temp_avg) AS days_complete
FROM (SELECT DISTINCT Year, {wk('Date')} AS Week,
        CAST(date_trunc('week', Date) AS DATE) AS Monday FROM weather) m
LEFT JOIN weather w ON w.Date >= m.Monday - 168 AND w.Date < m.Monday
GROUP BY ALL HAVING count(w.Temp_avg) < 168""", ["weather"])
def rolling_coverage(spark, d):
    from herdcast.operators import weather as wx
    return wx.rolling_coverage(fx.weather(spark, d))


