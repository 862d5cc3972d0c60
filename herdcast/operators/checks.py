"""Data-quality checks.

Each check returns a DataFrame of violations, so all problems are reported at once and
the work stays distributed; ``require`` turns the first violation into an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdcast.functions import calendar as cal
from herdcast.functions import expr as X


class CheckFailed(ValueError):
    """Raised by ``require`` with the first violation found."""


def require(violations: DataFrame, message: str) -> None:
    first = violations.limit(1).collect()
    if first:
        raise CheckFailed(f"{message}: {first[0].asDict()}")


def unique_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def required_columns(columns: Sequence[str], required: Sequence[str],
                     in_order: bool = False) -> list[str]:
    """Problems with a header: duplicates, missing names, or a wrong leading order."""
    seen, problems = set(), []
    for c in columns:
        if c in seen:
            problems.append(f"duplicate column {c}")
        seen.add(c)
    problems += [f"missing column {c}" for c in required if c not in seen]
    if in_order and not problems and tuple(columns[: len(required)]) != tuple(required):
        problems.append("leading columns are not " + ", ".join(required))
    return problems


def domain(df: DataFrame, col: str, allowed: Iterable[str], clean: Column | None = None
           ) -> DataFrame:
    """Rows whose (cleaned) value is null or not among the allowed values, per value."""
    value = clean if clean is not None else F.col(col)
    bad = df.filter(~F.coalesce(value.isin(*allowed), F.lit(False)))
    return bad.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def numeric_parse(df: DataFrame, col: str, blank_ok: bool = False, age: bool = False) -> DataFrame:
    """Texts that must be numbers but are not, with their row count."""
    parsed = X.parse_age(F.col(col)) if age else X.parse_number(F.col(col))
    bad = parsed.isNull()
    if blank_ok:
        bad = bad & F.col(col).isNotNull() & (F.trim(col) != "")
    return (df.filter(bad).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of nulls per mandatory column (columns without nulls are left out)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column", "n").filter("n > 0")


def in_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    bad = df.filter(~F.col(col).between(low, high))
    return bad.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def contiguous_dates(df: DataFrame, date: str = "Date", by: Sequence[str] = ("Year",)) -> DataFrame:
    """Each gap between consecutive days inside a group (first missing day and length)."""
    w = W.partitionBy(*by).orderBy(date)
    nxt = F.lead(date).over(w)
    return (df.select(*by, date).distinct()
            .withColumn("next", nxt)
            .filter(F.datediff("next", date) > 1)
            .select(*by, F.date_add(date, 1).alias("FirstMissing"),
                    (F.datediff("next", date) - 1).alias("MissingDays")))


def week_shape(weather: DataFrame, by: Sequence[str] = ("Year",)) -> DataFrame:
    """Inner weeks that do not hold each of the seven weekdays exactly once.

    ``weather`` has Week and Date; the first and last week of a group may be partial.
    """
    per_week = weather.groupBy(*by, "Week").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_distinct(F.weekday("Date")).alias("weekdays"))
    edge = W.partitionBy(*by)
    return (per_week
            .withColumn("lo", F.min("Week").over(edge)).withColumn("hi", F.max("Week").over(edge))
            .filter((F.col("Week") > F.col("lo")) & (F.col("Week") < F.col("hi"))
                    & ((F.col("days") != 7) | (F.col("weekdays") != 7)))
            .select(*by, "Week", "days", "weekdays"))


def text_in_count(long: DataFrame, drugs: Iterable[str]) -> DataFrame:
    """Drug names typed into a count column of a long sheet (Observation, Value)."""
    return long.filter(F.col("Observation").rlike(r"^F\d") & X.contains_drug(F.col("Value"), drugs))


def drugs_in_counts(sheet: DataFrame, drugs: Iterable[str]) -> DataFrame:
    """Sheet rows with a drug name in a count column; the cells are looked at inside their row."""
    counts = [c for c in sheet.columns if re.match(r"^F\d", c)]
    if not counts:
        return sheet.limit(0).select("Farm", "Year", "Name")
    drugs = list(drugs)
    cells = F.filter(F.array(*[F.col(c) for c in counts]), lambda v: X.contains_drug(v, drugs))
    return sheet.select("Farm", "Year", "Name", cells.alias("Value")).filter(F.size("Value") > 0)


def one_obs_per_week(parsed: DataFrame) -> DataFrame:
    """Animal-weeks with more than one number, treatment or treatment text."""
    return (parsed.groupBy("AnimalID", "Year", "Week")
            .agg(F.count("FEC").alias("numfec"), F.count_if("Dose").alias("numtx"),
                 F.count("DoseText").alias("numtext"))
            .filter("numfec > 1 OR numtx > 1 OR numtext > 1"))


def unknown_location(sheet: DataFrame, locations: DataFrame) -> DataFrame:
    """Animals per field whose location is not in the site dimension of that year."""
    keyed = sheet.withColumn("Field", F.col("Location")).withColumn(
        "Location", X.make_key(F.col("Farm"), F.col("Location")))
    return (keyed.join(locations, ["Farm", "Year", "Location"], "left_anti")
            .groupBy("Farm", "Year", "Field").agg(F.count(F.lit(1)).alias("n")))


def year_coverage(fec: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """Years with counts that another table lacks."""
    years = fec.select("Year").distinct()
    out = None
    for name, df in others.items():
        part = years.join(df.select("Year").distinct(), "Year", "left_anti").select(
            "Year", F.lit(name).alias("missing_from"))
        out = part if out is None else out.unionByName(part)
    return out


def year_span(fec: DataFrame) -> DataFrame:
    """First and last year, number of years, and whether they are at least 2 and consecutive."""
    span = fec.agg(F.min("Year").alias("first_year"), F.max("Year").alias("last_year"),
                   F.count_distinct("Year").alias("n_years"))
    return span.withColumn(
        "ok", (F.col("n_years") >= 2)
        & (F.col("last_year") - F.col("first_year") + 1 == F.col("n_years")))


def negative_counts(fec: DataFrame) -> DataFrame:
    """Rows whose egg count is below zero."""
    return fec.filter(F.col("FEC") < 0)


def missing_dates(sheet: DataFrame, header: DataFrame) -> DataFrame:
    """Farm-years whose sheet has no row of dates."""
    return sheet.select("Farm", "Year").distinct().join(header.select("Farm", "Year"), ["Farm", "Year"], "left_anti")


def group_invariants(group: DataFrame) -> DataFrame:
    """Location-weeks breaking: animals >= counted, animals >= dosed, bands >= 0."""
    d4, d8, d12 = F.col("DosedWithin4"), F.col("DosedWithin8"), F.col("DosedWithin12")
    total = F.col("TotalAnimals")
    return group.filter((total < F.col("TotalFEC")) | (total < d4 + d8 + d12)
                        | (d4 < 0) | (d8 < 0) | (d12 < 0))


def dosing_leverage(flags: DataFrame, cols: Sequence[str], minimum: int = 5) -> DataFrame:
    """True and false counts of each dose-lag flag, and whether both reach the minimum."""
    agg = flags.agg(*[F.struct(F.count_if(F.col(c)).alias("n_true"),
                               F.count_if(~F.col(c)).alias("n_false")).alias(c) for c in cols])
    return (agg.unpivot([], list(cols), "flag", "n")
            .select("flag", "n.n_true", "n.n_false")
            .withColumn("ok", (F.col("n_true") >= minimum) & (F.col("n_false") >= minimum)))


def coverage_dates(weather: DataFrame, year: int, as_of: str) -> DataFrame:
    """First and last day on record against what ``year`` needs as of a given day."""
    need_from = F.date_sub(F.make_date(F.lit(year), F.lit(1), F.lit(1)), 259)
    need_to = F.date_sub(F.lit(as_of).cast("date"), 7)
    return (weather.agg(F.min("Date").alias("first_day"), F.max("Date").alias("last_day"))
            .select("first_day", "last_day", (F.col("first_day") <= need_from).alias("start_ok"),
                    (F.col("last_day") >= need_to).alias("end_ok")))


def last_weeks(df: DataFrame) -> DataFrame:
    return df.select("*", cal.week_w(F.col("Date")).alias("Week"))
