"""Written outputs: coefficient list, code table, weather cache, next-season sheets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdcast.operators import checks as C
from herdcast.operators import features as feat
from herdcast.operators import weather as wx
from herdcast.schema import SEX_CODES, WEATHER_MEASURES
from herdcast.session import materialise
from herdcast.sources import readers


def write_coefficients(table: DataFrame, path: str, overwrite: bool = True) -> None:
    """The ordered coefficient list as one CSV file without a header (a few hundred rows)."""
    (table.orderBy("ord").select("groupcoefnames", "groupcoefs").coalesce(1)
     .write.mode("overwrite" if overwrite else "errorifexists")
     .csv(path, header=False, emptyValue="", nullValue=""))


def code_table(spark: SparkSession, codes: dict[str, str] = SEX_CODES) -> DataFrame:
    """Sex-code dimension: a blank row first, then by category and code."""
    rows = [(0, "", "")] + [(1, k, f"Sex{v}") for k, v in codes.items()]
    df = spark.createDataFrame(rows, "part int, Sex string, SexCategory string")
    return df.orderBy("part", "SexCategory", "Sex").select("Sex", "SexCategory")


def write_code_table(spark: SparkSession, path: str, codes: dict[str, str] = SEX_CODES) -> None:
    code_table(spark, codes).coalesce(1).write.mode("overwrite").csv(
        path, header=True, emptyValue="", nullValue="")


def weather_cache(daily: DataFrame, impute: str | None = None) -> DataFrame:
    """Calendar-filled daily table rounded to two digits, gaps optionally imputed."""
    filled = wx.calendar_fill(daily)
    if impute == "kalman":
        filled = wx.impute_gaps(filled)
    elif impute == "linear":
        filled = wx.impute_linear(filled)
    return wx.rounded(filled, 2)


def write_weather_cache(daily: DataFrame, path: str, impute: str | None = None) -> None:
    cache = wx.with_calendar_parts(weather_cache(daily, impute))
    cache.write.mode("overwrite").partitionBy("Year").parquet(path)


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table in a folder, or None if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def update_weather_cache(spark: SparkSession, landed: str, path: str, impute: str | None = None) -> DataFrame:
    """Takes files of hourly readings that the cache does not know yet into it, and gives the cache.

    Only files of days without a row are opened and rolled up; they join the cached days, gaps between the first and the last day become rows
    (imputed if asked), values are rounded, and the years in which a row changed are replaced. A file whose path has no date is
    an error.
    """
    files = readers.hourly_files(spark, landed)
    C.require(files.where("date IS NULL"), "a file without a date in its path")
    cache = stored_table(spark, path)
    columns = ("Date", *WEATHER_MEASURES)
    known = cache.select(*columns) if cache is not None else None
    if known is not None:
        files = files.join(known.select(F.col("Date").alias("date")), "date", "left_anti")
    new = [r["path"] for r in files.select("path").collect()]      # what landed since: opened, where known files are not
    if not new and cache is not None:
        days = known
    else:
        days = materialise(wx.hourly_weather_rollup(readers.read_hourly(spark, new or landed).drop("broken")).select(*columns), "new-days")
        days = days if known is None else known.unionByName(days)
    rows = materialise(wx.with_calendar_parts(weather_cache(days, impute)), "weather-cache")
    if cache is not None:
        changed = rows.select(*columns).exceptAll(known).select(F.year("Date").alias("Year")).distinct()
        rows = rows.join(changed, "Year", "left_semi")
    rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("Year").parquet(path)
    return spark.read.parquet(path)


def extract_weather(spark: SparkSession, landed: str, path: str, year: int, as_of: str, impute: str | None = None) -> DataFrame:
    """From landed files to the daily table of a season: the cache is updated, has to reach far enough, and is cut to the season."""
    cache = update_weather_cache(spark, landed, path, impute)
    C.require(C.coverage_dates(cache, year, as_of).where("NOT (start_ok AND end_ok)"), "days do not go back or forward far enough")
    season = wx.for_year(cache.select("Date", *WEATHER_MEASURES), year)
    C.require(C.week_shape(season), "weeks without their seven days")
    return season


def next_season_sheets(sheet: DataFrame) -> DataFrame:
    """Next season's animal rows of every farm: averages, ages, risks and notes carried over."""
    rows = feat.increment_age(feat.prev_season_average(sheet))
    return rows.select("Farm", (F.col("Year") + 1).alias("Year"), "Name", "Tag", "Sex", "Age",
                       "Location", "ClinicalRisk", "AvFEC", "OldNotes", "Notes")


def write_next_season(sheet: DataFrame, weather: DataFrame, coefficients: DataFrame, path: str,
                      year: int) -> None:
    """Sheets per farm, the year's weather and the coefficients, side by side in one folder."""
    (next_season_sheets(sheet).filter(F.col("Year") == year)
     .write.mode("overwrite").partitionBy("Farm").parquet(f"{path}/sheets"))
    wx.for_year(weather, year).write.mode("overwrite").parquet(f"{path}/WeatherData")
    write_coefficients(coefficients, f"{path}/EffectEstimates")
