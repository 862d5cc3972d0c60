"""Look-back features on weekly facts.

Every lag of the dense weekly grid is a range frame on the day number, so no grid of empty
weeks is built. Series are cut into blocks (``windows``), which bounds each window group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdcast.functions import calendar as cal
from herdcast.operators import windows as B

# Lag bands in weeks.
FEC_BANDS = {"fec4wk": (3, 5), "fec8wk": (7, 9), "fec12wk": (11, 13)}
DOSE_BANDS = {"dose5_12wk": (5, 12), "dose5_16wk": (5, 16), "dose9_16wk": (9, 16),
              "dose9_20wk": (9, 20), "dose13_20wk": (13, 20), "dose13_24wk": (13, 24)}
LOOKBACK_DAYS = 24 * 7
YEAR_LOOKBACK_DAYS = 2 * 371        # the whole of the year before, from any day of a year


def _frame(order: WindowSpec, band: tuple[int, int]) -> WindowSpec:
    near, far = band
    return order.rangeBetween(-7 * far, -7 * near)


def lag_mean_columns(order: WindowSpec, fec: str = "FEC") -> dict[str, Column]:
    return {n: F.avg(F.log1p(fec)).over(_frame(order, b)) for n, b in FEC_BANDS.items()}


def lag_dose_columns(order: WindowSpec, dose: str = "Dose") -> dict[str, Column]:
    return {n: F.coalesce(F.bool_or(dose).over(_frame(order, b)), F.lit(False))
            for n, b in DOSE_BANDS.items()}


def history_lags(facts: DataFrame, entity: Sequence[str] = ("AnimalID",),
                 mean: bool = True, dose: bool = True, last_year: bool = False) -> DataFrame:
    """Mean log count and any-treatment flags over the lag bands of each animal.

    ``last_year`` adds the log mean count of the animal's previous year at the same
    location; with blocks that reach back that far, it needs no shuffle of its own.
    """
    pos = cal.day_number(F.col("Monday"))
    lookback = YEAR_LOOKBACK_DAYS if last_year else LOOKBACK_DAYS
    rows = B.with_blocks(facts.withColumn("_pos", pos), F.col("_pos"), lookback, 4 * lookback)
    order = W.partitionBy(*entity, B.BLOCK).orderBy("_pos")
    cols = {}
    if last_year:
        year = W.partitionBy(*entity, B.BLOCK, "Location", "Farm").orderBy("Year")
        cols["lastYearMeanFEC"] = F.log1p(F.avg("FEC").over(year.rangeBetween(-1, -1)))
    if mean:
        cols |= lag_mean_columns(order)
    if dose:
        cols |= lag_dose_columns(order)
    return B.core_rows(rows.withColumns(cols)).drop("_pos")


def lag_weighted_mean(means: DataFrame, value: dict[str, str], n: str = "NFEC",
                      entity: Sequence[str] = ("Location",)) -> DataFrame:
    """Weighted means over the lag bands of each location, and the total weight.

    ``value`` maps an output prefix to its column: loc_obs -> GroupMean gives
    loc_obs_4wk, loc_obs_8wk, loc_obs_12wk; loc_n_* is the number of counts behind them.
    """
    pos = cal.day_number(F.col("Monday"))
    rows = B.with_blocks(means.withColumn("_pos", pos), F.col("_pos"), LOOKBACK_DAYS,
                         4 * LOOKBACK_DAYS)
    order = W.partitionBy(*entity, B.BLOCK).orderBy("_pos")
    cols = {}
    for tag, band in (("4wk", (3, 5)), ("8wk", (7, 9)), ("12wk", (11, 13))):
        w = _frame(order, band)
        cols[f"loc_n_{tag}"] = F.coalesce(F.sum(n).over(w), F.lit(0)).cast("long")
        for prefix, col in value.items():
            cols[f"{prefix}_{tag}"] = F.try_divide(
                F.sum(F.col(col) * F.col(n)).over(w),
                F.sum(n).over(w))
    return B.core_rows(rows.withColumns(cols)).drop("_pos")


def animal_year_mean(facts: DataFrame) -> DataFrame:
    """log(mean count + 1) of each animal's year at a location, keyed by the following year."""
    last = facts.agg(F.max("Year")).scalar()
    return (facts.groupBy("AnimalID", "Location", "Farm", "Year")
            .agg(F.log1p(F.avg("FEC")).alias("lastYearMeanFEC"))
            .filter(F.col("lastYearMeanFEC").isNotNull())
            .withColumn("Year", F.col("Year") + 1)
            .filter(F.col("Year") <= last))


def latest_row(facts: DataFrame, entity: Sequence[str] = ("AnimalID",), order: str = "Monday",
               dosed_only: bool = False) -> DataFrame:
    """The last (treated) row of each entity, as a partial aggregate rather than a sort."""
    rows = facts.filter("Dose") if dosed_only else facts
    keep = [c for c in facts.columns if c not in entity]
    latest = rows.groupBy(*entity).agg(
        F.max_by(F.struct(*keep), F.col(order)).alias("latest"))
    return latest.select(*entity, "latest.*")


def availability_tier(lastyear: bool = True) -> Column:
    """Which single earlier observation predicts the row: 4, 8, 12 weeks, or 0 for last year."""
    has = F.col("lastYearMeanFEC").isNotNull() if lastyear else F.lit(True)
    return (F.when(has & F.col("fec4wk").isNotNull(), 4)
            .when(has & F.col("fec8wk").isNotNull(), 8)
            .when(has & F.col("fec12wk").isNotNull(), 12)
            .when(F.col("lastYearMeanFEC").isNotNull(), 0))
