"""Landed files to conformed tables. Sheets and CSVs are read as text and parsed with care."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdcast.functions import expr as X
from herdcast.operators import checks as C
from herdcast.operators import conform, weather
from herdcast.schema import (HOURLY, HYGIENE_LEVELS, LOCATION_COLUMNS, RISK_LEVELS,
                             SHEET_FIRST_COLUMNS, WEATHER_COLUMNS, Options)


def read_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV or Parquet landing with every column as text; no schema inference.

    Giving ``columns`` fixes the schema without opening a file for its header.
    """
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
        return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    reader = spark.read.option("header", True).option("inferSchema", False)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def _header(df: DataFrame, required: Sequence[str], in_order: bool = False) -> None:
    problems = C.required_columns(df.columns, required, in_order)
    if problems:
        raise C.CheckFailed("; ".join(problems))


def conform_locations(raw: DataFrame, year: int | None = None, validate: bool = True) -> DataFrame:
    """Site dimension rows from a raw sheet (Farm, Location, Hygiene, Sensitivity)."""
    _header(raw, LOCATION_COLUMNS)
    if year is not None:
        raw = raw.withColumn("Year", F.lit(year))
    if validate:
        C.require(C.domain(raw, "Hygiene", HYGIENE_LEVELS), "unknown Hygiene")
        C.require(C.numeric_parse(raw, "Sensitivity"), "Sensitivity is not a number")
    return raw.select(F.col("Year").cast("int").alias("Year"), "Farm",
                      F.col("Location").alias("Field"),
                      X.make_key(F.col("Farm"), F.col("Location")).alias("Location"), "Hygiene",
                      X.parse_number(F.col("Sensitivity").cast("string")).alias("Sensitivity"))


def append_checked(stored: DataFrame | None, new: DataFrame, key: Sequence[str],
                   what: str) -> DataFrame:
    """Append rows of the same schema; a duplicated key is an error."""
    both = new if stored is None else stored.unionByName(new)
    C.require(C.unique_key(both, key), f"duplicated {what} key")
    return both


def load_locations(spark: SparkSession, path: str, year: int, stored: DataFrame | None = None
                   ) -> DataFrame:
    rows = conform_locations(read_text(spark, path), year)
    return append_checked(stored, rows, ("Farm", "Location", "Year"), "location")


def validate_sheet(sheet: DataFrame, options: Options = Options()) -> None:
    """All checks on the leading columns of the sheets; raises on the first violation."""
    _header(sheet.select(*[c for c in sheet.columns if c not in ("Farm", "Year")]),
            SHEET_FIRST_COLUMNS, in_order=True)
    C.require(C.not_null(sheet, ("Name", "Sex", "Age", "Location")), "blank mandatory cell")
    C.require(C.numeric_parse(sheet, "Age", age=True), "Age is not a number")
    C.require(C.numeric_parse(sheet, "AvFEC", blank_ok=True), "AvFEC is not a number")
    code = F.upper(F.regexp_replace("Sex", " ", ""))
    C.require(C.domain(sheet, "Sex", options.sex_codes, code), "unknown Sex code")
    C.require(C.domain(sheet, "ClinicalRisk", RISK_LEVELS, X.recode_risk(F.col("ClinicalRisk"))),
              "unknown ClinicalRisk")
    C.require(C.unique_key(sheet, ("Farm", "Year", "Name", "Tag")), "duplicated Name/Tag")


def _note_unknown_locations(sheet: DataFrame, locations: DataFrame) -> None:
    """Animals in fields that no location is known for stay, without location; a warning tells them. Only a load of which
    no row would have a location is refused."""
    unknown = C.unknown_location(sheet, locations).agg(
        F.count(F.lit(1)).alias("fields"), F.sum("n").alias("rows"), F.min_by(F.struct("Farm", "Year", "Field"), F.struct("Farm", "Year", "Field")).alias("one")).first()
    if not unknown["fields"]:
        return
    known = sheet.withColumn("Location", X.make_key(F.col("Farm"), F.col("Location"))).join(locations, ["Farm", "Year", "Location"], "left_semi")
    if known.isEmpty():
        raise C.CheckFailed(f"unknown location in every row, such as {unknown['one'].asDict()}")
    warnings.warn(f"{unknown['rows']} rows of {unknown['fields']} fields have no known location, such as {unknown['one'].asDict()}", stacklevel=3)


def load_dosing_sheets(sheet: DataFrame, locations: DataFrame, header: DataFrame | None = None,
                       options: Options = Options(), validate: bool = True,
                       stored: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Animal rows and weekly facts of all farm-year sheets at once, appended to the ``stored`` ones if given.

    ``sheet`` holds Farm, Year, the leading columns and F/T week columns as text; ``header``
    the row of dates of each sheet (omit it when the columns are calendar weeks already). Rows in an unknown field keep
    their facts, with a null location. Where no animal has two rows in a year, which an aggregate over the keys tells, facts
    are made inside their rows and nothing of the size of the cells is shuffled.
    """
    sheet = sheet.filter(F.col("Name").isNotNull() | F.col("Tag").isNotNull())
    if validate:
        validate_sheet(sheet, options)
        C.require(C.drugs_in_counts(sheet, options.drug_codes), "treatment in a count column")
        _note_unknown_locations(sheet, locations)
        if header is not None:
            C.require(C.missing_dates(sheet, header), "sheet without dates")
    by_row = not conform.repeated_animals(sheet)
    animals = conform.conform_animals(sheet, locations, options)
    facts = conform.conform_facts(sheet, locations, header, by_row)
    if validate:
        if not by_row or conform.several_columns_a_week(sheet.columns):
            keyed = sheet.withColumn("AnimalID", X.make_key(F.col("Farm"), F.col("Name")))
            cells = conform.parse_observations(conform.unpivot_weeks(keyed, ("AnimalID", "Year")))
            C.require(C.one_obs_per_week(cells), "more than one observation in a week")
        C.require(C.negative_counts(facts), "negative count")
        before = stored or (None, None)
        every = facts if before[1] is None and by_row else append_checked(before[1], facts, ("AnimalID", "Year", "Week"), "count")
        return append_checked(before[0], animals, ("Farm", "AnimalID", "Year"), "animal"), every
    if stored is not None:
        return stored[0].unionByName(animals), stored[1].unionByName(facts)
    return animals, facts


def read_coefficients(spark: SparkSession, path: str) -> dict[str, dict[str, float | None]]:
    """The written list of coefficients by section (a few hundred lines, one file); blank values are left-out terms."""
    files = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(files) != 1:
        raise C.CheckFailed("a coefficient list is one file")
    out: dict[str, dict[str, float | None]] = {}
    for line in csv.reader(files[0][0].splitlines()):
        name, value = [*line, "", ""][:2]
        if not value and name.endswith(":"):
            section = out.setdefault(name, {})
        elif name:
            if not out:
                raise C.CheckFailed(f"coefficient outside of a section: {name}")
            if name in section:
                raise C.CheckFailed(f"coefficient given twice: {name}")
            section[name] = float(value) if value else None
    return out


def load_weather(raw: DataFrame, stored: DataFrame | None = None,
                 years: Sequence[int] | None = None, replace: bool = True,
                 validate: bool = True) -> DataFrame:
    """Daily weather rows (text or typed), re-attributed, validated and upserted by date."""
    _header(raw, WEATHER_COLUMNS)
    numbers = raw.select(*[X.parse_number(F.col(c).cast("string")).alias(c)
                           for c in WEATHER_COLUMNS])
    if validate:
        C.require(C.not_null(numbers, ("Year", "Week", "Month")), "missing value")
        C.require(C.in_range(numbers, "Week", -40, 53), "week out of range")
        C.require(C.in_range(numbers, "Month", 1, 12), "month out of range")
    rows = weather.reattribute_year(numbers).filter(F.col("Day").isNotNull())
    text = F.concat_ws("-", *[F.format_string("%0" + w + "d", F.col(c).cast("int"))
                              for c, w in (("Year", "4"), ("Month", "2"), ("Day", "2"))])
    measures = ("Temp_low", "Temp_avg", "Temp_high", "Rel_Humidity_avg", "Abs_Humidity_avg")
    rows = rows.select(text.try_cast("date").alias("Date"),
                       *[F.col(c).cast("int").alias(c) for c in ("Year", "Month", "Day")],
                       *measures)
    if years is not None:
        rows = rows.filter(F.col("Year").isin(*years))
    if validate:
        C.require(C.not_null(rows, ("Date", *measures)), "missing value")
        C.require(C.contiguous_dates(rows), "missing date")
        if years is not None:
            have = {r[0] for r in rows.select("Year").distinct().collect()}
            lacking = sorted(set(years) - have)
            if lacking:
                raise C.CheckFailed(f"year not present in the data: {lacking[0]}")
    if stored is None:
        return append_checked(None, rows, ("Date",), "date") if validate else rows
    if replace:
        merged = weather.upsert_by_date(stored, rows)
        if validate:
            C.require(C.unique_key(merged, ("Date",)), "duplicated date key")
        return merged
    return append_checked(stored, rows, ("Date",), "date")


def _day_of(path: Column) -> Column:
    """The last date in a path, of its name (``2020/2020-01-05.json``) or of a folder."""
    return F.regexp_extract(path, r"^.*(?<![0-9])([0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9])", 1).try_cast("date")


def hourly_files(spark: SparkSession, folder: str) -> DataFrame:
    """(date, path) of the files in a folder; none of them is opened."""
    return spark.read.format("binaryFile").load(folder).select(_day_of(F.col("path")).alias("date"), "path")


def read_hourly(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(date, hourly, broken) of files of hourly readings, one JSON document a day, dated by their path.

    A file that is no JSON, or without an array of readings, is a row without readings; ``broken`` is its content.
    """
    fields = T.StructType([HOURLY["hourly"], T.StructField("broken", T.StringType())])
    return (spark.read.schema(fields).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "broken").json(path if isinstance(path, str) else list(path))
            .select(_day_of(F.col("_metadata.file_path")).alias("date"), "hourly",
                    F.when(F.col("hourly").isNull(), F.col("broken")).alias("broken")))
