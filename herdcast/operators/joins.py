"""Joins that need more than one DataFrame call: grids without cross joins, as-of, range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdcast.functions import calendar as cal
from herdcast.schema import HYGIENE_LEVELS


def season_grid(dims: DataFrame, weeks: tuple[int, int] = (0, 52)) -> DataFrame:
    """Farm x hygiene x year x week, for the levels on record.

    Only farms can be many; hygiene levels are an enumeration and years and weeks are
    calendar ranges, so the grid is three array expansions per farm and no join.
    """
    seen = dims.agg(F.collect_set(F.when(F.col("Hygiene").isin(*HYGIENE_LEVELS), F.col("Hygiene")))
                    .alias("hygiene"), F.array_sort(F.collect_set("Year")).alias("years"))
    return (dims.select("Farm").distinct()
            .withColumn("Hygiene", F.explode(seen.select("hygiene").scalar()))
            .withColumn("Year", F.explode(seen.select("years").scalar()))
            .withColumn("Week", F.explode(F.sequence(F.lit(weeks[0]), F.lit(weeks[1])))))


def dense_weeks(facts: DataFrame, entity: Sequence[str], monday: str) -> DataFrame:
    """Every week between the first and last on record for every entity, missing ones null."""
    span = facts.agg(F.min(monday).alias("lo"), F.max(monday).alias("hi"))
    weeks = F.sequence(span.select("lo").scalar(), span.select("hi").scalar(),
                       F.expr("interval 7 day"))
    grid = facts.select(*entity).distinct().withColumn(monday, F.explode(weeks))
    return grid.join(facts, [*entity, monday], "left")


def expand_to_members(curve: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A curve per group repeated for every member of the group; members without one stay."""
    return curve.join(members, list(keys), "right")


def range_join_days(points: DataFrame, daily: DataFrame, point: str, date: str, days: int,
                    aggs: dict[str, Column]) -> DataFrame:
    """Aggregate the ``days`` daily rows before each point.

    The axis is cut into buckets of ``days``; a day can only matter to points of its own
    bucket or the next, so the range join becomes an equi-join plus a filter, and the
    aggregate joins back to points without any day.
    """
    bucket = F.floor(cal.day_number(F.col(date)) / days)
    rows = daily.withColumn("_b", F.explode(F.array(bucket, bucket + 1)))
    keyed = points.select(point, F.floor(cal.day_number(F.col(point)) / days).alias("_b"))
    gap = F.datediff(F.col(point), F.col(date))
    hits = keyed.join(rows, "_b").filter(gap.between(1, days))
    out = points.join(hits.groupBy(point).agg(*[c.alias(n) for n, c in aggs.items()]),
                      point, "left")
    counts = [n for n, c in aggs.items() if "count" in str(c).lower()]
    return out.fillna(0, subset=counts) if counts else out


def asof_last_dose(facts: DataFrame, entity: Sequence[str] = ("AnimalID", "Year"),
                   lookback: int = 24) -> DataFrame:
    """Week of the last treatment before each row, from the two places it can be known.

    Either the latest earlier row says how long ago it was (Week - LastDose), or an earlier
    row is itself a treatment; the later of the two counts. A group is one animal's year.
    """
    w = W.partitionBy(*entity).orderBy("Week").rangeBetween(-lookback, -1)
    told = F.last(F.col("Week") - F.col("LastDose")).over(w)
    seen = F.max(F.when(F.col("Dose"), F.col("Week"))).over(w).cast("double")
    return (facts.select(*entity, "Week", F.greatest(told, seen).alias("LastDoseWeek"))
            .filter(F.col("LastDoseWeek").isNotNull()))
