"""Weather, joins, aggregates, lags and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from herdcast import fixtures as fx
from herdcast.functions import calendar as cal
from herdcast.operators import features as ft
from herdcast.operators import joins as J
from herdcast.operators import lags as L
from herdcast.operators import weather as wx
from herdcast.queries.base import (abs_hum, dose_prop, lag_dose_sql, lag_mean_sql, query, rel_hum,
                                   rolling_view, round_doubles, s6)
from herdcast.schema import WEATHER_MEASURES
from herdcast.session import materialise

_M = WEATHER_MEASURES


def _frames(spark, d):
    return fx.fec(spark, d), fx.animal(spark, d), fx.locations(spark, d)


# ------------------------------------------------------------------------------ weather
_HOURLY = f"""
SELECT D AS Date, {s6("max(t)")} AS Temp_high, {s6("avg(t)")} AS Temp_avg, {s6("min(t)")} AS Temp_low,
  {s6("avg(rh)")} AS Rel_Humidity_avg, {s6("avg(ah)")} AS Abs_Humidity_avg
FROM (SELECT D, t, rh, {abs_hum('t', 'rh')} AS ah
      FROM (SELECT D, t, {rel_hum('t', 'dp')} AS rh, dp
            FROM (SELECT CAST(l_shipdate AS DATE) AS D, avg(l_quantity) / 2 + 265 - 273.15 AS t,
                    avg(l_quantity) / 2 + 265 - l_linenumber - 273.15 AS dp
                  FROM lineitem GROUP BY CAST(l_shipdate AS DATE), l_linenumber)))
WHERE month(D) <> 1 GROUP BY D"""


@query("hourly_weather_rollup", _HOURLY)
def hourly_weather_rollup(spark, d):
    cache = fx.weather(spark, d).filter("Month = 1").select("Date")
    return round_doubles(wx.hourly_weather_rollup(fx.hourly_readings(spark, d), cache))


@query("abs_humidity", f"""
SELECT l_orderkey, l_linenumber, {s6(rel_hum('t', 'dp'))} AS rh,
  {s6(abs_hum('t', f"({rel_hum('t', 'dp')})"))} AS ah
FROM (SELECT l_orderkey, l_linenumber, l_quantity / 2 - 8 AS t,
        l_quantity / 2 - 8 - l_linenumber AS dp FROM lineitem)""")
def abs_humidity(spark, d):
    from herdcast.functions import expr as X
    t = F.col("l_quantity") / 2 - 8
    rh = X.rel_humidity(t, t - F.col("l_linenumber"))
    return round_doubles(fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", rh.alias("rh"), X.abs_humidity(t, rh).alias("ah")))


@query("calendar_fill", """
SELECT c.Site, c.Date, w.Temp_avg, w.Rel_Humidity_avg FROM site_calendar c LEFT JOIN site_days w
ON c.Site = w.Site AND c.Date = w.Date""", ["site_calendar"])
def calendar_fill(spark, d):
    return wx.calendar_fill(fx.site_days(spark, d).select("Site", "Date", "Temp_avg", "Rel_Humidity_avg"), ("Site",))


@query("impute_gaps")
def impute_gaps(spark, d):
    return round_doubles(wx.impute_gaps(wx.calendar_fill(fx.site_days(spark, d).select("Site", "Date", *_M), ("Site",)), ("Site",)))


# without noise and trend variance the smoothed level is the bridge between the neighbours, a straight line
@query("impute_gaps_bridge", f"""
SELECT Site, Date, {s6('coalesce(v, lo.v + (hi.v - lo.v) * (Date - lo.d) / nullif(hi.d - lo.d, 0), lo.v, hi.v)')} AS Temp_avg
FROM (SELECT Site, Date, v,
    last_value(p IGNORE NULLS) OVER (PARTITION BY Site ORDER BY Date ROWS UNBOUNDED PRECEDING) AS lo,
    first_value(p IGNORE NULLS) OVER (PARTITION BY Site ORDER BY Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi
  FROM (SELECT c.Site, c.Date, w.Temp_avg AS v, CASE WHEN w.Temp_avg IS NOT NULL THEN {{'d': c.Date, 'v': w.Temp_avg}} END AS p
        FROM site_calendar c LEFT JOIN site_days w ON c.Site = w.Site AND c.Date = w.Date))""", ["site_calendar"])
def impute_gaps_bridge(spark, d):
    daily = wx.calendar_fill(fx.site_days(spark, d).select("Site", "Date", "Temp_avg"), ("Site",))
    return round_doubles(wx.impute_gaps(daily, ("Site",), ("Temp_avg",), block_days=365, variances=(1e-10, 1.0, 0.0)))


@query("impute_linear", f"""
SELECT Site, Date, {s6('''coalesce(v, lo.v + (hi.v - lo.v) * (Date - lo.d) / nullif(hi.d - lo.d, 0),
  lo.v, hi.v)''')} AS Temp_avg
FROM (SELECT Site, Date, v,
    last_value(p IGNORE NULLS) OVER (PARTITION BY Site ORDER BY Date ROWS UNBOUNDED PRECEDING) AS lo,
    first_value(p IGNORE NULLS) OVER (PARTITION BY Site ORDER BY Date ROWS BETWEEN CURRENT ROW AND
      UNBOUNDED FOLLOWING) AS hi
  FROM (SELECT c.Site, c.Date, w.Temp_avg AS v,
          CASE WHEN w.Temp_avg IS NOT NULL THEN {{'d': c.Date, 'v': w.Temp_avg}} END AS p
        FROM site_calendar c LEFT JOIN site_days w ON c.Site = w.Site AND c.Date = w.Date))""", ["site_calendar"])
def impute_linear(spark, d):
    daily = wx.calendar_fill(fx.site_days(spark, d).select("Site", "Date", "Temp_avg"), ("Site",))
    return round_doubles(wx.impute_linear(daily, ("Site",), measures=("Temp_avg",)))


@query("weather_cache_write", f"""
SELECT c.Date, {', '.join(f'round_even(round(w.{m}, 9), 2) + 0 AS {m}' for m in _M)}
FROM (SELECT CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date FROM weather) c
LEFT JOIN weather w ON c.Date = w.Date""", ["weather"])
def weather_cache_write(spark, d):
    from herdcast.queries.base import scratch
    from herdcast.sources import sinks
    path = scratch(spark, "weather-cache")
    sinks.write_weather_cache(fx.weather(spark, d).select("Date", *_M), path)
    return spark.read.parquet(path).select("Date", *_M)


@query("week_backnumber", f"""
SELECT Date, CAST(Y AS INT) AS Year, CAST((date_trunc('week', Date)::DATE - fm) / 7 + 1 AS INT) AS Week,
  isodow(Date) AS WeekDay, Month, Day, {', '.join(f'round_even(round({m}, 9), 1) + 0 AS {m}' for m in _M)}
FROM (SELECT w.*, y.Y, CAST(date_trunc('week', make_date(y.Y, 1, 7)) AS DATE) AS fm
      FROM weather w CROSS JOIN (SELECT 1997 AS Y) y WHERE w.Year IN (y.Y, y.Y - 1))
WHERE (date_trunc('week', Date)::DATE - fm) / 7 + 1 >= -36""", ["weather"])
def week_backnumber(spark, d):
    return wx.for_year(fx.weather(spark, d), 1997)


@query("reattribute_year", f"""
SELECT Date, CASE WHEN Week < 0 OR (Week = 0 AND Month = 12) THEN CAST(Year AS INT) - 1
  ELSE CAST(Year AS INT) END AS Year, Week
FROM (SELECT Date, Month, year(Date + 120) AS Year,
  CAST((date_trunc('week', Date)::DATE
    - CAST(date_trunc('week', make_date(year(Date + 120), 1, 7)) AS DATE)) / 7 + 1 AS INT) AS Week
  FROM weather)""", ["weather"])
def reattribute_year(spark, d):
    # days from September on carry the coming year with a week counted back from it
    coming = F.year(F.date_add("Date", 120))
    rows = fx.weather(spark, d).select(
        "Date", "Month", coming.alias("Year"),
        cal.week_backnumber(F.col("Date"), coming).alias("Week"))
    return wx.reattribute_year(rows).select("Date", "Year", "Week")


@query("upsert_by_date", f"""
SELECT Date, Temp_avg, Rel_Humidity_avg FROM weather_o UNION ALL
SELECT Date, Temp_avg, Rel_Humidity_avg FROM weather_f
WHERE Date NOT IN (SELECT Date FROM weather_o)""", ["weather_o", "weather_f"])
def upsert_by_date(spark, d):
    cols = ("Date", "Temp_avg", "Rel_Humidity_avg")
    return wx.upsert_by_date(fx.weather(spark, d, "F").select(*cols),
                             fx.weather(spark, d, "O").select(*cols))


@query("replaced_count", """
SELECT count(*) AS replaced FROM weather_o WHERE Date IN (SELECT Date FROM weather_f)""",
       ["weather_o", "weather_f"])
def replaced_count(spark, d):
    return wx.replaced_count(fx.weather(spark, d, "F"), fx.weather(spark, d, "O"))


_ROLL = [f"{p}_{k}" for k in (0, 4, 8, 12, 16, 20, 24)
         for p in ("Temp_avg", "Temp_low", "Temp_frost", "RelHumid", "AbsHumid")]


@query("rolling_weather", "SELECT Year, Week, Monday, " + ", ".join(
    f"{s6(c)} AS {c}" for c in _ROLL) + " FROM rolling", ["rolling"])
def rolling_weather(spark, d):
    return round_doubles(wx.rolling_weather(fx.weather(spark, d)))


@query("rolling_weather_by_site", f"""
SELECT 'F' AS site, Year, Week, Monday, {s6('Temp_avg_4')} AS Temp_avg_4,
  {s6('Temp_frost_4')} AS Temp_frost_4 FROM ({rolling_view('weather_f', (4,))})
UNION ALL SELECT 'O', Year, Week, Monday, {s6('Temp_avg_4')}, {s6('Temp_frost_4')}
FROM ({rolling_view('weather_o', (4,))})""", ["weather_f", "weather_o"])
def rolling_weather_by_site(spark, d):
    both = (fx.weather(spark, d, "F").withColumn("site", F.lit("F"))
            .unionByName(fx.weather(spark, d, "O").withColumn("site", F.lit("O"))))
    return round_doubles(wx.rolling_weather(both, by=("site",), lags=(4,)).select(
        "site", "Year", "Week", "Monday", "Temp_avg_4", "Temp_frost_4"))


@query("join_range_28d", f"""
SELECT Monday, count(w.Date) AS days, {s6('avg(w.Temp_avg)')} AS Temp_avg
FROM (SELECT DISTINCT Monday FROM counts) m
LEFT JOIN weather w ON w.Date >= m.Monday - 28 AND w.Date < m.Monday GROUP BY 1""",
       ["counts", "weather"])
def join_range_28d(spark, d):
    mondays = fx.weekly_counts(spark, d).select("Monday").distinct()
    return round_doubles(J.range_join_days(
        mondays, fx.weather(spark, d), "Monday", "Date", 28,
        {"days": F.count("Date"), "Temp_avg": F.avg("Temp_avg")}))


@query("source_agreement", """
SELECT Variable, count(*) AS n, round(regr_slope(o, f), 6) AS slope,
  round(regr_intercept(o, f), 6) AS intercept, round(corr(o, f), 6) AS correlation
FROM (SELECT f.Date, f.Variable, f.v AS f, o.v AS o
  FROM (UNPIVOT (SELECT Date, {m} FROM weather_f) ON {m} INTO NAME Variable VALUE v) f
  JOIN (UNPIVOT (SELECT Date, {m} FROM weather_o) ON {m} INTO NAME Variable VALUE v) o
    ON f.Date = o.Date AND f.Variable = o.Variable) GROUP BY 1""".replace("{m}", ", ".join(_M)),
       ["weather_f", "weather_o"])
def source_agreement(spark, d):
    return round_doubles(wx.source_agreement(
        fx.weather(spark, d, "F"), fx.weather(spark, d, "O"), ("F", "O")))


# -------------------------------------------------------------------------------- joins
@query("join_left_dim", f"""
SELECT AnimalID, Location, Monday, FEC, Farm, Sex, AgeCat, Hygiene, TotalAnimals,
  {s6('MeanAge')} AS MeanAge FROM ind_rows""", ["ind_rows"])
def join_left_dim(spark, d):
    return round_doubles(ft.individual_rows(*_frames(spark, d)).select(
        "AnimalID", "Location", "Monday", "FEC", "Farm", "Sex", "AgeCat", "Hygiene",
        "TotalAnimals", "MeanAge"))


@query("join_inner_predict", """
SELECT f.Location, f.Year, f.Week, f.AnimalID, f.FEC, n.FEC AS NextFEC
FROM counts f JOIN counts n ON f.Location = n.Location AND f.Year = n.Year
  AND f.AnimalID = n.AnimalID AND f.Week + 4 = n.Week""", ["counts"])
def join_inner_predict(spark, d):
    f = fx.weekly_counts(spark, d).select("Location", "Year", "Week", "AnimalID", "FEC")
    nxt = f.withColumn("Week", F.col("Week") - 4).withColumnRenamed("FEC", "NextFEC")
    return f.join(nxt, ["Location", "Year", "Week", "AnimalID"], "inner")


_CURVE = """(SELECT l.Year, l.Farm, l.Hygiene, c.Week, avg(ln(FEC + 1)) AS v FROM counts c
  JOIN locations l ON c.Location = l.Location AND c.Year = l.Year GROUP BY ALL)"""


def _curve(spark, d):
    """Mean log count per farm, hygiene, year and week: the curve expanded to locations.

    The facts are reduced to location-weeks before the site dimension is joined.
    """
    weekly = (fx.weekly_counts(spark, d).groupBy("Location", "Year", "Week")
              .agg(F.sum(F.log1p("FEC")).alias("s"), F.count("FEC").alias("n")))
    dim = fx.locations(spark, d).select("Location", "Year", "Farm", "Hygiene")
    return (weekly.join(dim, ["Location", "Year"]).groupBy("Year", "Farm", "Hygiene", "Week")
            .agg((F.sum("s") / F.sum("n")).alias("v")))


@query("join_right_expand", f"""
SELECT l.Year, l.Farm, l.Hygiene, l.Location, c.Week, {s6('c.v')} AS v
FROM {_CURVE} c RIGHT JOIN locations l
  ON c.Year = l.Year AND c.Farm = l.Farm AND c.Hygiene = l.Hygiene""", ["counts", "locations"])
def join_right_expand(spark, d):
    return round_doubles(J.expand_to_members(
        _curve(spark, d), fx.locations(spark, d), ("Year", "Farm", "Hygiene"))
        .select("Year", "Farm", "Hygiene", "Location", "Week", "v"))


@query("join_full_outer", """
SELECT coalesce(f.Date, o.Date) AS Date, f.Temp_avg AS first, o.Temp_avg AS second
FROM weather_f f FULL JOIN weather_o o ON f.Date = o.Date""", ["weather_f", "weather_o"])
def join_full_outer(spark, d):
    f = fx.weather(spark, d, "F").select("Date", F.col("Temp_avg").alias("first"))
    o = fx.weather(spark, d, "O").select("Date", F.col("Temp_avg").alias("second"))
    return f.join(o, "Date", "full")


@query("join_cross_grid", """
SELECT f.Farm, h.Hygiene, y.Year, w.Week FROM (SELECT DISTINCT Farm FROM locations) f
CROSS JOIN (SELECT DISTINCT Hygiene FROM locations) h CROSS JOIN years y
CROSS JOIN (SELECT CAST(unnest(generate_series(0, 52)) AS INT) AS Week) w""",
       ["locations", "years"])
def join_cross_grid(spark, d):
    return J.season_grid(fx.locations(spark, d))


@query("join_dense_weeks", """
SELECT a.AnimalID, w.Monday, c.FEC FROM (SELECT DISTINCT AnimalID FROM counts) a
CROSS JOIN (SELECT CAST(unnest(generate_series(min(Monday), max(Monday), INTERVAL 7 DAY)) AS DATE)
  AS Monday FROM counts) w
LEFT JOIN counts c ON a.AnimalID = c.AnimalID AND w.Monday = c.Monday""", ["counts"])
def join_dense_weeks(spark, d):
    facts = fx.weekly_counts(spark, d).select("AnimalID", "Monday", "FEC")
    return J.dense_weeks(facts, ("AnimalID",), "Monday")


@query("join_anti", """
SELECT Site, Date FROM site_calendar WHERE (Site, Date) NOT IN (SELECT (Site, Date) FROM site_days)""",
       ["site_calendar"])
def join_anti(spark, d):
    cached = fx.site_days(spark, d).select("Site", "Date")
    return wx.calendar_fill(cached, ("Site",)).join(cached, ["Site", "Date"], "left_anti")


@query("join_semi", """
SELECT AnimalID, Monday, FEC FROM counts WHERE (Location, Year) IN
  (SELECT (Location, Year) FROM group_week WHERE DosedWithin4 > 0)""", ["counts", "group_week"])
def join_semi(spark, d):
    treated = ft.group_week_summary(fx.fec(spark, d)).filter("DosedWithin4 > 0")
    return (fx.weekly_counts(spark, d).join(treated, ["Location", "Year"], "left_semi")
            .select("AnimalID", "Monday", "FEC"))


@query("join_asof_last_dose", """
SELECT AnimalID, Year, Week, max(v) AS LastDoseWeek FROM (
  SELECT f.AnimalID, f.Year, f.Week,
    CASE WHEN p.Week = max(p.Week) OVER (PARTITION BY f.AnimalID, f.Year, f.Week)
         THEN p.Week - p.LastDose END AS v
  FROM fec f JOIN fec p ON f.AnimalID = p.AnimalID AND f.Year = p.Year
    AND p.Week < f.Week AND p.Week >= f.Week - 24
  UNION ALL
  SELECT f.AnimalID, f.Year, f.Week, p.Week FROM fec f JOIN fec p ON f.AnimalID = p.AnimalID
    AND f.Year = p.Year AND p.Week < f.Week AND p.Week >= f.Week - 24 AND p.Dose)
GROUP BY 1, 2, 3 HAVING max(v) > CAST('-Infinity' AS DOUBLE)""", ["fec"])
def join_asof_last_dose(spark, d):
    return J.asof_last_dose(fx.fec(spark, d)).filter("LastDoseWeek > double('-Infinity')")


# --------------------------------------------------------------------------- aggregates
@query("group_week_summary", f"""
SELECT Location, Year, Week, Monday, {s6('meanLogFEC')} AS meanLogFEC, TotalFEC, DosedWithin4,
  DosedWithin8, DosedWithin12 FROM group_week""", ["group_week"])
def group_week_summary(spark, d):
    return round_doubles(ft.group_week_summary(fx.fec(spark, d)))


@query("location_summary", f"""
SELECT Farm, Location, Year, Hygiene, Sensitivity, {s6('MeanAge')} AS MeanAge, TotalAnimals
FROM loc_summary""", ["loc_summary"])
def location_summary(spark, d):
    return round_doubles(ft.location_summary(fx.animal(spark, d), fx.locations(spark, d)))


@query("group_model_data", f"""
SELECT {s6('meanLogFEC')} AS meanLogFEC, TotalFEC, g.Year, concat(Location, '_', g.Year) AS LocationYear,
  Location, concat(Farm, '_', Hygiene) AS FarmHygiene, g.Monday, g.Week, {s6('sdoy')} AS sdoy,
  {s6('cdoy')} AS cdoy, Farm, Hygiene, {s6('MeanAge')} AS MeanAge, TotalAnimals,
  {', '.join(f"{s6(dose_prop(k))} AS DoseProp{k}" for k in (4, 8, 12))},
  {', '.join(f"{s6(c)} AS {c}" for c in _ROLL)}
FROM group_rows g LEFT JOIN rolling r ON g.Year = r.Year AND g.Week = r.Week
  AND g.Monday = r.Monday""", ["group_rows", "rolling"])
def group_model_data(spark, d):
    rolling = wx.rolling_weather(fx.weather(spark, d))
    return round_doubles(ft.group_model_data(*_frames(spark, d), rolling))


@query("individual_model_data", f"""
SELECT AnimalID, Location, i.Year, i.Week, i.Monday, FEC, Count, Dose, Farm, Sex, AgeCat, Hygiene,
  {s6('sdoy')} AS sdoy, {s6('DoseProp4')} AS DoseProp4, {s6('DoseProp8')} AS DoseProp8,
  {s6('DoseProp12')} AS DoseProp12, LastDoseCat, TotalAnimals,
  {', '.join(f"{s6(c)} AS {c}" for c in _ROLL)}
FROM ind_rows i LEFT JOIN rolling r ON i.Year = r.Year AND i.Week = r.Week
  AND i.Monday = r.Monday""", ["ind_rows", "rolling"])
def individual_model_data(spark, d):
    rolling = wx.rolling_weather(fx.weather(spark, d))
    return round_doubles(ft.individual_model_data(*_frames(spark, d), rolling).select(
        "AnimalID", "Location", "Year", "Week", "Monday", "FEC", "Count", "Dose", "Farm", "Sex",
        "AgeCat", "Hygiene", "sdoy", "DoseProp4", "DoseProp8", "DoseProp12", "LastDoseCat",
        "TotalAnimals", *_ROLL))


@query("animal_year_mean_lagged", f"""
SELECT AnimalID, Location, Farm, CAST(Year AS INT) AS Year,
  {s6('lastYearMeanFEC')} AS lastYearMeanFEC
FROM year_mean WHERE Year <= (SELECT max(Year) FROM ind_rows)""", ["year_mean", "ind_rows"])
def animal_year_mean_lagged(spark, d):
    home = fx.animal(spark, d).select("AnimalID", "Location", "Year", "Farm")
    rows = ft.filter_season(fx.fec(spark, d)).join(home, ["AnimalID", "Location", "Year"])
    return round_doubles(L.animal_year_mean(materialise(rows, "facts")))


@query("sampling_events", f"""
SELECT Farm, Location, Year, Hygiene, Week, TotalFEC AS n, TotalAnimals, {s6('MeanAge')} AS MeanAge
FROM group_rows WHERE Hygiene IS NOT NULL""", ["group_rows"])
def sampling_events(spark, d):
    return round_doubles(ft.sampling_events(*_frames(spark, d)))


@query("mean_group_size", """
SELECT Year, Farm, Location, round_even(avg(TotalFEC), 1) AS MeanTotalFEC
FROM group_rows GROUP BY 1, 2, 3""", ["group_rows"])
def mean_group_size(spark, d):
    return ft.mean_group_size(ft.group_rows(*_frames(spark, d)))


@query("hygiene_weekly_mean", f"""
SELECT c.Location, Hygiene, Monday, {s6('avg(FEC)')} AS meanCount FROM counts c
JOIN locations l ON c.Location = l.Location AND c.Year = l.Year GROUP BY 1, 2, 3""",
       ["counts", "locations"])
def hygiene_weekly_mean(spark, d):
    return round_doubles(ft.hygiene_weekly_mean(
        fx.weekly_counts(spark, d), fx.locations(spark, d)))


@query("center_means", f"""
SELECT {s6('avg(lastYearMeanFEC)')} AS feclastyearmean, {s6('avg(fec4wk)')} AS fec4wkmean,
  {s6('avg(fec8wk)')} AS fec8wkmean, {s6('avg(fec12wk)')} AS fec12wkmean FROM history""",
       ["history"])
def center_means(spark, d):
    rows = ft.history_features(ft.individual_rows(*_frames(spark, d)))
    return round_doubles(ft.center_means(rows))


# ---------------------------------------------------------------------------------- lags
@query("lag_mean_fec", "SELECT AnimalID, Monday, " + ", ".join(
    f"{s6(lag_mean_sql(a, b))} AS {n}" for n, a, b in
    (("fec4wk", 3, 5), ("fec8wk", 7, 9), ("fec12wk", 11, 13))) + " FROM counts", ["counts"])
def lag_mean_fec(spark, d):
    facts = fx.weekly_counts(spark, d).select("AnimalID", "Monday", "FEC")
    return round_doubles(L.history_lags(facts, dose=False).drop("FEC"))


@query("lag_any_dose", "SELECT AnimalID, Monday, " + ", ".join(
    f"{lag_dose_sql(a, b)} AS dose{a}_{b}wk" for a, b in
    ((5, 12), (5, 16), (9, 16), (9, 20), (13, 20), (13, 24))) + " FROM counts", ["counts"])
def lag_any_dose(spark, d):
    facts = fx.weekly_counts(spark, d).select("AnimalID", "Monday", "Dose")
    return L.history_lags(facts, mean=False).drop("Dose")


def _wm(expr: str, lo: int, hi: int) -> str:
    return (f"{expr} OVER (PARTITION BY Location ORDER BY Monday RANGE BETWEEN "
            f"INTERVAL {7 * hi} DAY PRECEDING AND INTERVAL {7 * lo} DAY PRECEDING)")


@query("lag_weighted_mean", "SELECT Location, Monday, " + ", ".join(
    f"CAST(coalesce({_wm('sum(TotalFEC)', a, b)}, 0) AS BIGINT) AS loc_n_{t}, "
    f"{s6(_wm('sum(meanLogFEC * TotalFEC)', a, b) + ' / ' + _wm('sum(TotalFEC)', a, b))} "
    f"AS loc_obs_{t}" for t, a, b in (("4wk", 3, 5), ("8wk", 7, 9), ("12wk", 11, 13)))
    + " FROM group_week", ["group_week"])
def lag_weighted_mean(spark, d):
    means = ft.group_week_summary(fx.fec(spark, d)).select(
        "Location", "Monday", "meanLogFEC", F.col("TotalFEC").alias("NFEC"))
    lagged = L.lag_weighted_mean(means, {"loc_obs": "meanLogFEC"})
    return round_doubles(lagged.drop("meanLogFEC", "NFEC"))


@query("latest_row_per_animal", """
SELECT a.AnimalID, a.Monday, a.FEC, d.Monday AS LastDosed FROM
  (SELECT AnimalID, max(Monday) AS Monday, max_by(FEC, Monday) AS FEC FROM counts GROUP BY 1) a
  LEFT JOIN (SELECT AnimalID, max(Monday) AS Monday FROM counts WHERE Dose GROUP BY 1) d
  ON a.AnimalID = d.AnimalID""", ["counts"])
def latest_row_per_animal(spark, d):
    facts = fx.weekly_counts(spark, d).select("AnimalID", "Monday", "FEC", "Dose")
    last = L.latest_row(facts).select("AnimalID", "Monday", "FEC")
    dosed = L.latest_row(facts, dosed_only=True).select(
        "AnimalID", F.col("Monday").alias("LastDosed"))
    return last.join(dosed, "AnimalID", "left")


@query("history_features", f"""
SELECT AnimalID, Monday, Sex, AgeCat, LastDoseCat, {s6('Obs')} AS Obs,
  {s6('lastYearMeanFEC')} AS lastYearMeanFEC, {s6('fec4wk')} AS fec4wk, {s6('fec8wk')} AS fec8wk,
  {s6('fec12wk')} AS fec12wk, dose5_12wk, dose9_16wk, dose13_20wk FROM history""", ["history"])
def history_features(spark, d):
    rows = ft.history_features(ft.individual_rows(*_frames(spark, d)))
    return round_doubles(rows.select(
        "AnimalID", "Monday", "Sex", "AgeCat", "LastDoseCat", "Obs", "lastYearMeanFEC", "fec4wk",
        "fec8wk", "fec12wk", "dose5_12wk", "dose9_16wk", "dose13_20wk"))


@query("availability_tier", "SELECT Year, Tier, count(*) AS n FROM history GROUP BY 1, 2",
       ["history"])
def availability_tier(spark, d):
    rows = ft.history_features(ft.individual_rows(*_frames(spark, d)))
    return rows.groupBy("Year", "Tier").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ sorts and set operations
@query("sort_report", f"""
SELECT Year, Farm, Location, Week, {s6('exp(meanLogFEC) - 1')} AS Observed, TotalFEC AS N
FROM group_rows ORDER BY Year, Farm, Location, Week""", ["group_rows"])
def sort_report(spark, d):
    rows = ft.group_rows(*_frames(spark, d)).select(
        "Year", "Farm", "Location", "Week", F.expm1("meanLogFEC").alias("Observed"),
        F.col("TotalFEC").alias("N"))
    return round_doubles(rows).orderBy("Year", "Farm", "Location", "Week")


@query("union_append", """
SELECT 'F' AS Source, Date, Temp_avg FROM weather_f UNION ALL
SELECT 'O', Date, Temp_avg FROM weather_o""", ["weather_f", "weather_o"])
def union_append(spark, d):
    a, b = (fx.weather(spark, d, s).select(F.lit(s).alias("Source"), "Date", "Temp_avg")
            for s in ("F", "O"))
    return a.unionByName(b)


@query("distinct_dims", """
SELECT DISTINCT Year, Farm, Hygiene, Location FROM group_rows""", ["group_rows"])
def distinct_dims(spark, d):
    return ft.sampling_events(*_frames(spark, d)).select(
        "Year", "Farm", "Hygiene", "Location").distinct()


@query("unpivot_long", "SELECT Date, Variable, Value FROM (UNPIVOT (SELECT Date, {m} FROM weather) "
       "ON {m} INTO NAME Variable VALUE v) t(Date, Variable, Value)"
       .replace("{m}", "Temp_avg, Temp_low, Temp_high"), ["weather"])
def unpivot_long(spark, d):
    ms = ["Temp_avg", "Temp_low", "Temp_high"]
    return fx.weather(spark, d).unpivot(["Date"], ms, "Variable", "Value")


@query("pivot_wide", """
SELECT Date, max(CASE WHEN s = 'F' THEN t END) AS F, max(CASE WHEN s = 'O' THEN t END) AS O
FROM (SELECT 'F' AS s, Date, Temp_avg AS t FROM weather_f UNION ALL
      SELECT 'O', Date, Temp_avg FROM weather_o) GROUP BY 1""", ["weather_f", "weather_o"])
def pivot_wide(spark, d):
    return union_append(spark, d).groupBy("Date").pivot("Source", ["F", "O"]).agg(
        F.first("Temp_avg"))


