"""Sheets to facts: loaders and the projections they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from herdcast import fixtures as fx
from herdcast.functions import calendar as cal
from herdcast.functions import expr as X
from herdcast.operators import conform as cf
from herdcast.operators import features as ft
from herdcast.queries.base import age_band, dose_cat, dose_prop, query, r6, round_doubles, s6, wk
from herdcast.session import materialise
from herdcast.sources import readers, sinks

_ANIMAL_KEY = "concat(Farm, '_', regexp_replace(Name, '\\s', '', 'g'))"


def _raw_locations(spark, d):
    return fx.locations(spark, d).select(
        "Year", "Farm", F.col("Field").alias("Location"), "Hygiene",
        F.col("Sensitivity").cast("string").alias("Sensitivity"))


@query("load_locations",
       "SELECT Year, Farm, Field, Location, Hygiene, Sensitivity FROM locations", ["locations"])
def load_locations(spark, d):
    return readers.conform_locations(_raw_locations(spark, d), validate=False)


@query("load_dosing_sheet", f"""
SELECT AnimalID, Location, Year, Week, FEC, Count, Dose, DoseText, Monday,
  {s6("LastDose")} AS LastDose FROM fec""", ["fec"])
def load_dosing_sheet(spark, d):
    landed = materialise(fx.wide_sheet(spark, d), "sheets")             # sheets are files; making them is no part of the load
    _, facts = readers.load_dosing_sheets(landed, fx.locations(spark, d), validate=False)
    return facts.withColumn("LastDose", r6("LastDose"))


@query("load_dosing_sheet_animals", f"""
SELECT Year, Farm, CASE WHEN Location = 'Back Field' THEN NULL
    ELSE concat(Farm, '_', replace(Location, ' ', '')) END AS Location,
  Location AS Field, {_ANIMAL_KEY} AS AnimalID, Tag,
  CASE Sex WHEN 'dkf' THEN 'DKF' WHEN ' dkg' THEN 'DKM' WHEN 'Hy F' THEN 'MUPY' END AS Sex,
  CASE WHEN Age = '<1' THEN 0 ELSE try_cast(Age AS DOUBLE) END AS Age,
  {age_band("CASE WHEN Age = '<1' THEN 0 ELSE try_cast(Age AS DOUBLE) END")} AS AgeCat,
  {s6("try_cast(AvFEC AS DOUBLE)")} AS AvFEC,
  CASE WHEN ClinicalRisk IS NULL THEN 'Normal' WHEN ClinicalRisk = 'Very High' THEN 'VeryHigh'
    WHEN ClinicalRisk = ' high' THEN 'High' WHEN ClinicalRisk = 'Normal' THEN 'Normal' END
    AS ClinicalRisk
FROM raw_animals""", ["raw_animals"])
def load_dosing_sheet_animals(spark, d):
    return round_doubles(cf.conform_animals(fx.raw_animals(spark, d), fx.locations(spark, d)))


def _text_weather(spark, d, status):
    w = fx.weather(spark, d, status)
    return w.select(*[F.col(c).cast("string").alias(c) for c in w.columns if c != "Date"],
                    cal.week_w(F.col("Date")).cast("string").alias("Week"))


@query("load_weather", f"""
SELECT Date, Year, Month, Day, {s6("Temp_low")} AS Temp_low, {s6("Temp_avg")} AS Temp_avg,
  {s6("Temp_high")} AS Temp_high, {s6("Rel_Humidity_avg")} AS Rel_Humidity_avg,
  {s6("Abs_Humidity_avg")} AS Abs_Humidity_avg
FROM (SELECT * FROM weather_o UNION ALL SELECT * FROM weather_f
      WHERE Date NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_linestatus = 'O'))
WHERE NOT (Month = 12 AND FALSE)""", ["weather_f", "weather_o"])
def load_weather(spark, d):
    rows = readers.load_weather(_text_weather(spark, d, "O"), stored=fx.weather(spark, d, "F"),
                                validate=False)
    return round_doubles(rows)


@query("write_code_table", """
SELECT t.Sex, t.SexCategory, CAST(count(a.Tag) AS BIGINT) AS animals
FROM (VALUES ('', ''), ('DKF','SexDKF'), ('DKM','SexDKM'), ('DKG','SexDKM'), ('DG','SexDKM'),
  ('DKS','SexDKM'), ('DK(RIG)','SexDKM'), ('PYF','SexMUPY'), ('MUF','SexMUPY'), ('PYG','SexMUPY'),
  ('MUG','SexMUPY'), ('MUS','SexMUPY'), ('POG','SexMUPY'), ('POF','SexMUPY'), ('HOF','SexMUPY'),
  ('HYF','SexMUPY'), ('HYG','SexMUPY'), ('HYS','SexMUPY'), ('HOG','SexMUPY'), ('MUPY','SexMUPY'))
  AS t(Sex, SexCategory)
LEFT JOIN raw_animals a ON upper(replace(a.Sex, ' ', '')) = t.Sex GROUP BY 1, 2""",
       ["raw_animals"])
def write_code_table(spark, d):
    used = (fx.raw_animals(spark, d)
            .groupBy(F.upper(F.regexp_replace("Sex", " ", "")).alias("Sex"))
            .agg(F.count("Tag").alias("animals")))
    return (sinks.code_table(spark).join(used, "Sex", "left")
            .select("Sex", "SexCategory", F.coalesce("animals", F.lit(0)).alias("animals")))


_PREV = f"""
SELECT a.Farm, a.Year, regexp_replace(a.AnimalID, '^.*_', '') AS Name, a.Tag, a.Sex,
  a.Field AS Location, a.ClinicalRisk, round_even(f.m, 0) AS AvFEC, a.Age
FROM animal a JOIN (SELECT AnimalID, Location, Year, avg(FEC) AS m FROM counts GROUP BY ALL) f
  ON a.AnimalID = f.AnimalID AND a.Location = f.Location AND a.Year = f.Year
WHERE a.Field <> 'DEAD'"""


@query("prev_season_average", f"SELECT Farm, Year, Name, Tag, AvFEC FROM ({_PREV})",
       ["animal", "counts"])
def prev_season_average(spark, d):
    return ft.prev_season_average(fx.wide_sheet(spark, d)).select(
        "Farm", "Year", "Name", "Tag", "AvFEC")


_NEXT = f"""
SELECT Farm, CAST(Year + 1 AS INT) AS Year, Name, Tag, Sex, Age + 1 AS Age, Location,
  ClinicalRisk, AvFEC, concat('note ', Tag) AS OldNotes, '' AS Notes FROM ({_PREV})"""


@query("next_season_sheets", _NEXT, ["animal", "counts"])
def next_season_sheets(spark, d):
    return sinks.next_season_sheets(fx.wide_sheet(spark, d))


@query("increment_age", """
SELECT Farm, Year, Name, Tag,
  CASE WHEN Age = '<1' THEN 0 ELSE try_cast(Age AS DOUBLE) END + 1 AS Age,
  coalesce(ClinicalRisk, 'Normal') AS ClinicalRisk, concat('note ', Tag) AS OldNotes, '' AS Notes
FROM raw_animals""", ["raw_animals"])
def increment_age(spark, d):
    rows = fx.raw_animals(spark, d).withColumn("Notes", F.concat(F.lit("note "), "Tag"))
    return ft.increment_age(rows).select("Farm", "Year", "Name", "Tag", "Age", "ClinicalRisk",
                                         "OldNotes", "Notes")


@query("normalise_headers", """
SELECT n.name, CAST(count(*) AS BIGINT) AS cells FROM (VALUES ('Name'), ('AvFEC'), ('Tag'),
  ('Sex'), ('Age'), ('Location'), ('ClinicalRisk')) AS n(name)
CROSS JOIN raw_animals GROUP BY 1""", ["raw_animals"])
def normalise_headers(spark, d):
    raw = fx.raw_animals(spark, d).drop("Farm", "Year").withColumnsRenamed(
        {"AvFEC": "Average FEC", "ClinicalRisk": "Clinical Risk"})
    sheet = raw.toDF(*cf.normalise_headers(raw.columns))
    counts = sheet.agg(*[F.count(F.lit(1)).alias(c) for c in sheet.columns])
    return counts.unpivot([], sheet.columns, "name", "cells")


@query("week_offset", f"""
SELECT Farm, Year, m AS RefDate, CAST(n - {wk('m')} AS INT) AS WeekOffset
FROM (SELECT Farm, f.Year AS Year, min(Monday) AS m, min(Week) + Year % 2 AS n
      FROM counts f JOIN (SELECT DISTINCT Location AS L, Farm FROM locations) ON Location = L
      GROUP BY Farm, f.Year)""", ["counts", "locations"])
def week_offset(spark, d):
    # each sheet's row of dates: its first counted week, in odd years under a shifted column
    sites = fx.locations(spark, d).select("Location", "Farm").distinct()
    first = (fx.weekly_counts(spark, d).join(sites, "Location").groupBy("Farm", "Year")
             .agg(F.min("Monday").alias("m"), (F.min("Week") + F.col("Year") % 2).alias("n")))
    serial = F.datediff("m", F.lit("1899-12-30").cast("date")).cast("string")
    header = first.select("Farm", "Year", *[
        F.when(F.col("n") == w, serial).alias(f"F{w}") for w in range(0, 55)])
    return cf.week_offset(header)


@query("unpivot_weeks", """
SELECT AnimalID, Location, Year, concat('F', Week) AS Observation,
  concat(CAST(CAST(FEC AS BIGINT) AS VARCHAR), '.0') AS Value FROM counts
UNION ALL SELECT AnimalID, Location, Year, concat('T', Week), DoseText FROM counts WHERE Dose""",
       ["counts"])
def unpivot_weeks(spark, d):
    sheet = fx.wide_sheet(spark, d).withColumns({
        "AnimalID": X.make_key(F.col("Farm"), F.col("Name")),
        "Location": X.make_key(F.col("Farm"), F.col("Location"))})
    return cf.unpivot_weeks(sheet).filter(F.col("Value").isNotNull())


@query("fold_count_and_treatment",
       "SELECT AnimalID, Location, Year, Week, FEC, Dose, DoseText FROM counts", ["counts"])
def fold_count_and_treatment(spark, d):
    return cf.fold_count_and_treatment(cf.parse_observations(unpivot_weeks(spark, d)))


@query("raw_count", """
SELECT f.AnimalID, f.Location, f.Year, f.Week, f.FEC / l.Sensitivity AS Count
FROM counts f LEFT JOIN locations l ON f.Location = l.Location AND f.Year = l.Year""",
       ["counts", "locations"])
def raw_count(spark, d):
    facts = fx.weekly_counts(spark, d).drop("Count")
    return cf.raw_count(facts, fx.locations(spark, d)).select(
        "AnimalID", "Location", "Year", "Week", "Count")


@query("age_band", f"""
SELECT {age_band('Age')} AS AgeCat, count(*) AS n, min(Age) AS lo, max(Age) AS hi
FROM (SELECT CASE WHEN Age = '<1' THEN 0 ELSE try_cast(Age AS DOUBLE) END AS Age FROM raw_animals)
GROUP BY 1""", ["raw_animals"])
def age_band_q(spark, d):
    age = X.parse_age(F.col("Age"))
    return (fx.raw_animals(spark, d).select(age.alias("Age"))
            .groupBy(X.age_band(F.col("Age")).alias("AgeCat"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("Age").alias("lo"), F.max("Age").alias("hi")))


@query("recode_sex", """
SELECT Sex AS code, CASE upper(replace(Sex, ' ', '')) WHEN 'DKF' THEN 'DKF' WHEN 'DKG' THEN 'DKM'
  WHEN 'HYF' THEN 'MUPY' END AS Sex, count(*) AS n FROM raw_animals GROUP BY 1, 2""",
       ["raw_animals"])
def recode_sex(spark, d):
    return (fx.raw_animals(spark, d)
            .groupBy(F.col("Sex").alias("code"), X.recode_sex(F.col("Sex")).alias("Sex"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("recode_risk", """
SELECT ClinicalRisk AS code, CASE lower(replace(coalesce(ClinicalRisk, 'normal'), ' ', ''))
  WHEN 'normal' THEN 'Normal' WHEN 'high' THEN 'High' WHEN 'veryhigh' THEN 'VeryHigh' END
  AS ClinicalRisk, count(*) AS n FROM raw_animals GROUP BY 1, 2""", ["raw_animals"])
def recode_risk(spark, d):
    risk = X.recode_risk(F.col("ClinicalRisk"))
    return (fx.raw_animals(spark, d)
            .groupBy(F.col("ClinicalRisk").alias("code"), risk.alias("ClinicalRisk"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("make_keys", f"""
SELECT Year, {_ANIMAL_KEY} AS AnimalID, concat(Farm, '_', replace(Location, ' ', '')) AS Location
FROM raw_animals""", ["raw_animals"])
def make_keys(spark, d):
    return fx.raw_animals(spark, d).select(
        "Year", X.make_key(F.col("Farm"), F.col("Name")).alias("AnimalID"),
        X.make_key(F.col("Farm"), F.col("Location")).alias("Location"))


@query("monday_of_week",
       "SELECT Year, Week, Monday, count(*) AS n FROM counts GROUP BY ALL", ["counts"])
def monday_of_week(spark, d):
    return (fx.weekly_counts(spark, d).groupBy("Year", "Week").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("Monday", cal.monday_of_week(F.col("Year"), F.col("Week"))))


@query("last_dose_weeks", """
SELECT AnimalID, Location, Monday, round(LastDose, 6) AS LastDose FROM fec""", ["fec"])
def last_dose_weeks(spark, d):
    return cf.last_dose_weeks(fx.weekly_counts(spark, d)).select(
        "AnimalID", "Location", "Monday", r6("LastDose"))


@query("dose_text_tally", "SELECT DoseText, count(*) AS n FROM counts WHERE Dose GROUP BY 1",
       ["counts"])
def dose_text_tally(spark, d):
    return cf.dose_text_tally(fx.weekly_counts(spark, d))


@query("load_summary", """
SELECT Year, min(Week) AS first_week, min(Monday) AS first_monday, count(*) AS observations,
  count(DISTINCT AnimalID) AS animals, count(DISTINCT Location) AS locations
FROM counts GROUP BY Year""", ["counts"])
def load_summary(spark, d):
    return cf.load_summary(fx.weekly_counts(spark, d))


@query("season_terms", f"""
SELECT Location, Year, Week, {s6("sin(Week * (2 * pi()) / 52)")} AS sdoy,
  {s6("cos(Week * (2 * pi()) / 52)")} AS cdoy
FROM (SELECT DISTINCT Location, Year, Week FROM counts)""", ["counts"])
def season_terms(spark, d):
    weeks = fx.weekly_counts(spark, d).select("Location", "Year", "Week").distinct()
    return round_doubles(ft.with_season_terms(weeks))


@query("dose_prop_group", "SELECT Location, Monday, " + ", ".join(
    f"{s6(dose_prop(k))} AS DoseProp{k}" for k in (4, 8, 12)) + " FROM group_rows", ["group_rows"])
def dose_prop_group(spark, d):
    rows = ft.group_rows(fx.fec(spark, d), fx.animal(spark, d), fx.locations(spark, d))
    return round_doubles(ft.with_group_doses(rows).select(
        "Location", "Monday", "DoseProp4", "DoseProp8", "DoseProp12"))


@query("dose_prop_individual", f"""
SELECT AnimalID, Monday, {s6("DoseProp4")} AS DoseProp4, {s6("DoseProp8")} AS DoseProp8,
  {s6("DoseProp12")} AS DoseProp12 FROM ind_rows""", ["ind_rows"])
def dose_prop_individual(spark, d):
    props = X.dose_prop_individual(F.col("LastDose"), 0.95)
    rows = ft.filter_season(fx.fec(spark, d))
    return round_doubles(rows.withColumns(props).select("AnimalID", "Monday", *props))


@query("last_dose_category", f"""
SELECT {dose_cat('LastDose')} AS LastDoseCat, count(*) AS n FROM fec GROUP BY 1""", ["fec"])
def last_dose_category(spark, d):
    return (fx.fec(spark, d)
            .groupBy(X.last_dose_category(F.col("LastDose")).alias("LastDoseCat"))
            .agg(F.count(F.lit(1)).alias("n")))


_TOP = """(SELECT '{0}' AS factor, {0} AS level, count(*) AS n FROM ind_rows
  WHERE {0} IS NOT NULL GROUP BY 2 ORDER BY n DESC, level LIMIT 1)"""


@query("reference_level", " UNION ALL ".join(_TOP.format(c) for c in ("Farm", "Sex", "AgeCat")),
       ["ind_rows"])
def reference_level(spark, d):
    rows = ft.individual_rows(fx.fec(spark, d), fx.animal(spark, d), fx.locations(spark, d))
    out = None
    for c in ("Farm", "Sex", "AgeCat"):
        top = cf.reference_level(rows, c).select(F.lit(c).alias("factor"), "level", "n")
        out = top if out is None else out.unionByName(top)
    return out


@query("top1_level", """
SELECT LastDoseCat AS level, count(*) AS n FROM ind_rows GROUP BY 1 ORDER BY n DESC, level
LIMIT 1""", ["ind_rows"])
def top1_level(spark, d):
    rows = ft.filter_season(fx.fec(spark, d)).withColumn(
        "LastDoseCat", X.last_dose_category(F.col("LastDose")))
    return cf.reference_level(rows, "LastDoseCat")
