"""Weather operators: hourly rollup, calendar fill, gap imputation, rolling measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdcast.functions import calendar as cal
from herdcast.functions import expr as X
from herdcast.operators import windows as B
from herdcast.schema import WEATHER_LAGS, WEATHER_MEASURES

KELVIN = 273.15


def hourly_weather_rollup(files: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """Daily temperature and humidity from files of hourly readings (date, hourly array).

    Dates already in ``cache`` are skipped. A file without readable readings gives nulls,
    which imputation can fill, rather than a day of zeros.
    """
    if cache is not None:
        files = files.join(cache.select(F.col("Date").alias("date")).distinct(), "date",
                           "left_anti")
    temp = F.col("r.temp") - KELVIN
    dew = F.col("r.dew_point") - KELVIN
    rh = X.rel_humidity(temp, dew)
    return (files.select("date", F.explode_outer("hourly").alias("r"))
            .select(F.col("date").alias("Date"), temp.alias("t"), rh.alias("rh"),
                    X.abs_humidity(temp, rh).alias("ah"))
            .groupBy("Date")
            .agg(F.max("t").alias("Temp_high"), F.avg("t").alias("Temp_avg"),
                 F.min("t").alias("Temp_low"), F.avg("rh").alias("Rel_Humidity_avg"),
                 F.avg("ah").alias("Abs_Humidity_avg")))


def calendar_fill(daily: DataFrame, by: Sequence[str] = (), date: str = "Date") -> DataFrame:
    """Every day between the first and last day on record (of each group); gaps are null rows."""
    days = F.explode(F.sequence(F.min(date), F.max(date), F.expr("interval 1 day")))
    span = daily.groupBy(*by) if by else daily.groupBy()
    return span.agg(days.alias(date)).join(daily, [*by, date], "left")


def half_even(col: str, digits: int) -> Column:
    """Half-even rounding that first drops the noise of floating subtraction."""
    return F.bround(F.round(col, 9), digits)


def rounded(daily: DataFrame, digits: int, measures: Sequence[str] = WEATHER_MEASURES) -> DataFrame:
    return daily.withColumns({m: half_even(m, digits) for m in measures})


def with_calendar_parts(daily: DataFrame) -> DataFrame:
    return daily.select("*", F.year("Date").alias("Year"), F.month("Date").alias("Month"),
                        F.dayofmonth("Date").alias("Day"))


def for_year(daily: DataFrame, year: int) -> DataFrame:
    """The year's daily table of a season: the previous year's days get week numbers
    counted back from the year's first Monday (0, -1, ...), down to week -36."""
    week = cal.week_backnumber(F.col("Date"), F.lit(year))
    first = F.make_date(F.lit(year - 1), F.lit(1), F.lit(1))
    last = F.make_date(F.lit(year), F.lit(12), F.lit(31))
    return (daily.filter(F.col("Date").between(first, last) & (week >= -36))
            .select("Date", F.lit(year).alias("Year"), week.alias("Week"),
                    (F.weekday("Date") + 1).alias("WeekDay"), F.month("Date").alias("Month"),
                    F.dayofmonth("Date").alias("Day"),
                    *[half_even(m, 1).alias(m) for m in WEATHER_MEASURES]))


def reattribute_year(weather: DataFrame) -> DataFrame:
    """Rows in a negative week, or in week 0 of December, belong to the year before."""
    before = (F.col("Week") < 0) | ((F.col("Week") == 0) & (F.col("Month") == 12))
    return weather.withColumn("Year", F.when(before, F.col("Year") - 1).otherwise(F.col("Year")))


def upsert_by_date(stored: DataFrame, new: DataFrame, key: Sequence[str] = ("Date",)) -> DataFrame:
    """New rows replace stored rows with the same key."""
    keys = new.select(*key).distinct()
    return stored.join(keys, list(key), "left_anti").unionByName(new)


def replaced_count(stored: DataFrame, new: DataFrame, key: Sequence[str] = ("Date",)) -> DataFrame:
    return (new.join(stored.select(*key), list(key), "left_semi")
            .agg(F.count(F.lit(1)).alias("replaced")))


_SOURCES = {"Temp_avg": "Temp_avg", "Temp_low": "Temp_low", "RelHumid": "Rel_Humidity_avg",
            "AbsHumid": "Abs_Humidity_avg"}


def rolling_columns(lags: Sequence[int] = WEATHER_LAGS) -> list[str]:
    return [f"{p}_{k}" for k in lags
            for p in ("Temp_avg", "Temp_low", "Temp_frost", "RelHumid", "AbsHumid")]


def _on_mondays(daily: DataFrame, by: Sequence[str], lookback: int, block: int) -> DataFrame:
    """Daily rows plus one asking row per week on record, cut into window blocks."""
    values = daily.select(*by, cal.day_number(F.col("Date")).alias("pos"),
                          *[F.col(c) for c in _SOURCES.values()],
                          F.lit(None).cast("int").alias("Year"), F.lit(None).cast("int").alias("Week"))
    monday = cal.monday_of_week(F.year("Date"), cal.week_w(F.col("Date")))
    asking = (daily.select(*by, F.year("Date").alias("Year"),
                           cal.week_w(F.col("Date")).alias("Week"), monday.alias("Monday"))
              .distinct()
              .select(*by, cal.day_number(F.col("Monday")).alias("pos"), "Year", "Week"))
    both = values.unionByName(asking, allowMissingColumns=True)
    return B.with_blocks(both, F.col("pos"), lookback, block)


def rolling_weather(daily: DataFrame, by: Sequence[str] = (), lags: Sequence[int] = WEATHER_LAGS,
                    block_days: int = 1456) -> DataFrame:
    """Per week: five measures over the 28 days ending ``7 * lag + 1`` days before its Monday.

    A measure is null unless all 28 days are on record with a value. The weeks ask their
    questions as extra rows of the window input, so a Monday without a reading of its own
    still gets its row, and all lags share one sort.
    """
    far = (max(lags) + 4) * 7
    rows = _on_mondays(daily, by, far, block_days)
    order = W.partitionBy(*by, B.BLOCK).orderBy("pos")
    out = []
    for k in lags:
        w = order.rangeBetween(-(k + 4) * 7, -(k * 7 + 1))

        def full(measure: str, value: Column) -> Column:
            return F.when(F.count(measure).over(w) == 28, value)
        out += [
            full("Temp_avg", F.avg("Temp_avg").over(w)).alias(f"Temp_avg_{k}"),
            full("Temp_low", F.min("Temp_low").over(w)).alias(f"Temp_low_{k}"),
            full("Temp_low", F.count_if(F.col("Temp_low") < 0).over(w)).cast("double")
            .alias(f"Temp_frost_{k}"),
            full("Rel_Humidity_avg", F.avg("Rel_Humidity_avg").over(w)).alias(f"RelHumid_{k}"),
            full("Abs_Humidity_avg", F.avg("Abs_Humidity_avg").over(w)).alias(f"AbsHumid_{k}")]
    return (rows.select(*by, "Year", "Week", "pos", B.CORE, *out)
            .filter(F.col(B.CORE) & F.col("Week").isNotNull())
            .select(*by, "Year", "Week",
                    F.date_from_unix_date(F.col("pos").cast("int")).alias("Monday"),
                    *rolling_columns(lags)))


def rolling_coverage(daily: DataFrame, by: Sequence[str] = (), weeks: int = 24,
                     block_days: int = 1456) -> DataFrame:
    """Weeks whose preceding ``weeks`` are short of days or hold missing values."""
    days = weeks * 7
    rows = _on_mondays(daily, by, days, block_days)
    w = W.partitionBy(*by, B.BLOCK).orderBy("pos").rangeBetween(-days, -1)
    present = F.count(F.when(F.col("Week").isNull(), F.lit(1))).over(w)
    whole = F.lit(True)
    for c in _SOURCES.values():
        whole = whole & F.col(c).isNotNull()
    filled = F.count(F.when(F.col("Week").isNull() & whole, F.lit(1))).over(w)
    return (rows.select(*by, "Year", "Week", "pos", B.CORE, present.alias("days_present"),
                        filled.alias("days_complete"))
            .filter(F.col(B.CORE) & F.col("Week").isNotNull() & (F.col("days_complete") < days))
            .select(*by, "Year", "Week",
                    F.date_from_unix_date(F.col("pos").cast("int")).alias("Monday"),
                    "days_present", "days_complete"))


def source_agreement(first: DataFrame, second: DataFrame, names: tuple[str, str],
                     measures: Sequence[str] = WEATHER_MEASURES) -> DataFrame:
    """Two providers side by side: per-measure linear fit of the second on the first."""
    def long(df: DataFrame, name: str) -> DataFrame:
        return (df.select("Date", *measures)
                .unpivot(["Date"], list(measures), "Variable", "Value")
                .withColumn("Source", F.lit(name)))
    a, b = names
    both = (long(first, a).unionByName(long(second, b))
            .groupBy("Date", "Variable").pivot("Source", [a, b]).agg(F.first("Value"))
            .filter(F.col(a).isNotNull() & F.col(b).isNotNull()))
    return both.groupBy("Variable").agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(b, a).alias("slope"),
        F.regr_intercept(b, a).alias("intercept"), F.corr(b, a).alias("correlation"))


def impute_linear(daily: DataFrame, by: Sequence[str] = (),
                  measures: Sequence[str] = WEATHER_MEASURES, block_days: int = 1456) -> DataFrame:
    """Fill gaps on the straight line between their neighbours; ends repeat the nearest value.

    The axis is cut into blocks. Each block reports its first and last known point, the
    nearest known points outside it are looked up among those few rows, and the rest is a
    window inside the block, so no task holds a whole series and gaps may be of any length.
    """
    rows = (daily.withColumn("_pos", cal.day_number(F.col("Date")))
            .withColumn(B.BLOCK, F.floor(F.col("_pos") / block_days).cast("long")))

    def point(m: str) -> Column:
        return F.when(F.col(m).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(m).alias("v")))
    keys = [*by, B.BLOCK]
    ends = rows.groupBy(*keys).agg(
        *[F.min_by(point(m), F.when(F.col(m).isNotNull(), F.col("_pos"))).alias(f"_first_{m}")
          for m in measures],
        *[F.max_by(point(m), F.when(F.col(m).isNotNull(), F.col("_pos"))).alias(f"_last_{m}")
          for m in measures])
    among = W.partitionBy(*by).orderBy(B.BLOCK)
    ends = ends.select(
        *keys,
        *[F.last(f"_last_{m}", True).over(among.rowsBetween(W.unboundedPreceding, -1))
          .alias(f"_before_{m}") for m in measures],
        *[F.first(f"_first_{m}", True).over(among.rowsBetween(1, W.unboundedFollowing))
          .alias(f"_after_{m}") for m in measures])
    order = W.partitionBy(*keys).orderBy("_pos")
    back = order.rowsBetween(W.unboundedPreceding, 0)
    ahead = order.rowsBetween(0, W.unboundedFollowing)
    filled = {}
    for m in measures:
        lo = F.coalesce(F.last(point(m), True).over(back), F.col(f"_before_{m}"))
        hi = F.coalesce(F.first(point(m), True).over(ahead), F.col(f"_after_{m}"))
        share = (F.col("_pos") - lo["p"]) / F.nullif(hi["p"] - lo["p"], F.lit(0))
        filled[m] = F.coalesce(F.col(m), lo["v"] + (hi["v"] - lo["v"]) * share, lo["v"], hi["v"])
    return rows.join(ends, keys).withColumns(filled).select(*daily.columns)


def impute_gaps(daily: DataFrame, by: Sequence[str] = (), measures: Sequence[str] = WEATHER_MEASURES, block_days: int = 1456,
                variances: tuple[float, float, float] | None = None) -> DataFrame:
    """Fill gaps by the smoothed level of a level-and-slope model of each measure of each series.

    ``daily`` has one row per calendar day (``calendar_fill``). The variances (noise, level, slope) are of maximum likelihood, by
    series and measure, or the given ones for all. The axis is cut into blocks; a task has one block of one series, and what
    blocks say about each other is composed from a few numbers a block (:mod:`smoothing`), so that no task holds a whole series
    and the blocks change no result. A measure without any reading stays null.
    """
    import numpy as np
    import pandas as pd

    from herdcast.operators import smoothing as S
    from herdcast.session import materialise
    measures, by, k = list(measures), list(by), len(measures)
    rows = daily.withColumn("_pos", cal.day_number(F.col("Date"))).withColumn(B.BLOCK, F.floor(F.col("_pos") / block_days).cast("long"))
    held = materialise(rows.select(*by, "Date", "_pos", B.BLOCK, *[F.col(m).cast("double").alias(m) for m in measures]), "days")
    mean = F.array(*[F.coalesce(F.avg(m), F.lit(0.0)) for m in measures]).alias("_mean")
    series = held.groupBy(*by).agg(mean) if by else held.agg(mean)
    kinds = {f.name: f.dataType.simpleString() for f in held.schema}
    keys = ", ".join(f"`{c}` {kinds[c]}" for c in by)
    keys_comma = keys + ", " if keys else ""

    def with_series(df: DataFrame, own: DataFrame) -> DataFrame:
        return df.join(own, by) if by else df.crossJoin(own)      # without keys there is one series: one row

    def readings(pdf: pd.DataFrame) -> np.ndarray:
        pdf = pdf.sort_values("_pos")
        return pdf[measures].to_numpy(dtype="float64") - np.asarray(pdf["_mean"].iloc[0], dtype="float64")

    def tried(pdf: pd.DataFrame, round_: int) -> np.ndarray:
        """measures x candidates x (q1, q2)"""
        if variances is not None:
            return np.tile(np.log(np.maximum(np.array(variances[1:]) / variances[0], 1e-300)), (k, 1, 1))
        if round_ == 0:
            return np.tile(S.candidates(None, 0), (k, 1, 1))
        best = np.asarray(pdf["_best"].iloc[0], dtype="float64").reshape(k, 2)
        return best[:, None] if round_ == S.ROUNDS else np.stack([S.candidates(b, round_) for b in best])

    def scales(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r = variances[0] if variances is not None else 1.0
        q = np.exp(logs.reshape(-1, 2)) * r
        return np.full(len(q), r), np.where(q < 1e-200, 0.0, q)

    def elements(round_: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            logs = tried(pdf, round_)
            y = np.repeat(readings(pdf), logs.shape[1], axis=1)
            out = pdf[[*by, B.BLOCK, *(["_best"] if round_ else [])]].iloc[:1].copy()
            out["blob"] = [S.filter_block(y, *scales(logs)).pack().tobytes()]
            return out
        extra = ", `_best` array<double>" if round_ else ""
        return with_series(held, series).groupBy(*by, B.BLOCK).applyInPandas(run, f"{keys_comma}`{B.BLOCK}` long{extra}, blob binary")

    def scanned(pdf: pd.DataFrame) -> list[S.Element]:
        return [S.Element.unpack(np.frombuffer(b).reshape(-1, S.SIZE)) for b in pdf.sort_values(B.BLOCK)["blob"]]

    def best_of(round_: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            logs = tried(pdf, round_)
            value = S.profile(scanned(pdf)).reshape(k, -1)
            out = pdf[by].iloc[:1].copy()
            out["_best"] = [logs[np.arange(k), value.argmin(1)].ravel().tolist()]
            return out
        found = elements(round_).groupBy(*by).applyInPandas(run, f"{keys_comma}`_best` array<double>")
        return materialise(found, "variances")

    last = S.ROUNDS
    if variances is None:
        for round_ in range(S.ROUNDS):
            own = best_of(round_)
            series = with_series(series.drop("_best"), own)

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(B.BLOCK)
        out = pdf[[*by, B.BLOCK]].copy()
        out["_ends"] = [e.tobytes() for e in S.ends(scanned(pdf))]
        return out

    if variances is not None:
        series = series.withColumn("_best", F.lit(None).cast("array<double>"))
    states = elements(last).groupBy(*by).applyInPandas(ends, f"{keys_comma}`{B.BLOCK}` long, _ends binary")

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        filled = S.smooth_block(readings(pdf), *scales(tried(pdf, last)), np.frombuffer(pdf["_ends"].iloc[0]).reshape(k, -1))
        known = np.asarray(pdf["_known"].iloc[0], dtype=bool)
        out = pdf[[*by, "Date"]].copy()
        for i, m in enumerate(measures):
            own = pdf[m].to_numpy(dtype="float64")
            out[m] = np.where(np.isnan(own), filled[:, i] + pdf["_mean"].iloc[0][i] if known[i] else np.nan, own)
        return out

    seen = F.array(*[F.count(m) > 0 for m in measures]).alias("_known")
    series = with_series(series, held.groupBy(*by).agg(seen) if by else held.agg(seen))
    blocks = with_series(held, series).join(states, [*by, B.BLOCK])
    types = ", ".join(f"`{m}` double" for m in measures)
    filled = blocks.groupBy(*by, B.BLOCK).applyInPandas(smooth, f"{keys_comma}Date date, {types}")
    filled = filled.withColumns({m: F.nanvl(m, F.lit(None).cast("double")) for m in measures})
    rest = [c for c in daily.columns if c not in (*measures, *by, "Date")]
    return (filled.join(daily.select(*by, "Date", *rest), [*by, "Date"]) if rest else filled).select(*daily.columns)
