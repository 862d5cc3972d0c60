"""Adapter views: the herd tables derived from the general test tables.

``fec`` and ``weather`` reduce the big fact table before anything is joined to it, so the
dimensions meet weekly facts, not raw rows. No join here carries a broadcast hint: the
supplier side grows with the data, so its strategy is left to Spark's size statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from herdcast.functions import calendar as cal
from herdcast.functions import expr as X
from herdcast.operators.conform import last_dose_weeks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_date() -> Column:
    return F.col("l_shipdate").cast("date")


def with_years(df: DataFrame, spark: SparkSession, sf_dir: str, col: str = "Year") -> DataFrame:
    """One copy of each row per year of a Monday on record (a handful of years)."""
    years = (table(spark, sf_dir, "lineitem")
             .agg(F.array_sort(F.collect_set(F.year(cal.monday_of(ship_date())))).alias("ys")))
    return df.withColumn(col, F.explode(years.scalar()))


def _farm() -> Column:
    return F.concat(F.lit("FARM_"), (F.col("r_regionkey") % 2).cast("string"))


def _place() -> list[Column]:
    return [_farm().alias("Farm"), F.col("r_name").alias("Field"),
            X.make_key(_farm(), F.col("r_name")).alias("Location")]


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    hyg = (F.when(F.col("r_regionkey") % 3 == 0, "None")
           .when(F.col("r_regionkey") % 3 == 1, "Automated").otherwise("Manual"))
    dim = table(spark, sf_dir, "region").select(
        *_place(), hyg.alias("Hygiene"), F.lit(50.0).alias("Sensitivity"))
    return with_years(dim, spark, sf_dir).select(
        "Year", "Farm", "Field", "Location", "Hygiene", "Sensitivity")


def _supplier_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
            .join(reg, nat.n_regionkey == reg.r_regionkey)
            .select("s_suppkey", "s_acctbal", *_place(),
                    X.make_key(_farm(), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")))
                    .alias("AnimalID")))


def animal(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    base = with_years(_supplier_place(spark, sf_dir), spark, sf_dir)
    age = (key % 30 + (F.col("Year") - 1995)).cast("double")
    return base.select(
        "Year", "Farm", "Location", "Field", "AnimalID",
        F.concat(F.lit("T"), key.cast("string")).alias("Tag"),
        F.when(key % 3 == 0, "DKF").when(key % 3 == 1, "DKM").otherwise("MUPY").alias("Sex"),
        age.alias("Age"), X.age_band(age).alias("AgeCat"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal") / 10).alias("AvFEC"),
        F.when(key % 20 == 0, "VeryHigh").when(key % 7 == 0, "High").otherwise("Normal")
        .alias("ClinicalRisk"))


def weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per animal and week: count, treatment flag and text (no LastDose yet)."""
    monday = cal.monday_of(ship_date())
    weekly = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", monday.alias("Monday"))
        .agg(F.avg("l_quantity").alias("q"),
             F.bool_or((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
                       & (F.col("l_quantity") > 25)).alias("Dose")))
    sup = _supplier_place(spark, sf_dir).select("s_suppkey", "AnimalID", "Location")
    drug = F.element_at(F.array(*[F.lit(d) for d in ("MOX", "FBZ", "IVM", "PYR")]),
                        (F.col("l_suppkey") % 4 + 1).cast("int"))
    fec = F.floor(F.col("q") / 4).cast("double") * 50
    return (weekly.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
            .select("AnimalID", "Location", F.year("Monday").alias("Year"),
                    cal.week_w(F.col("Monday")).alias("Week"), fec.alias("FEC"),
                    (fec / 50).alias("Count"), "Dose",
                    F.when(F.col("Dose"), drug).alias("DoseText"), "Monday"))


def fec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_dose_weeks(weekly_counts(spark, sf_dir))


def weather(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Daily weather; ``status`` restricts to one of the two providers."""
    items = table(spark, sf_dir, "lineitem")
    if status is not None:
        items = items.filter(F.col("l_linestatus") == status)
    day = ship_date()
    daily = items.groupBy(day.alias("Date")).agg(
        F.avg("l_quantity").alias("q"), F.avg("l_linenumber").alias("n"))
    wave = F.cos(F.dayofyear("Date") * F.lit(2 * 3.141592653589793) / 365.25)
    ta = F.round(F.lit(10) - wave * 8 + (F.col("q") - 25) / 2, 2)
    rh = F.round(F.lit(60) + F.col("n") * 4, 2)
    return (daily.select("Date", ta.alias("ta"), rh.alias("rh"))
            .select("Date", F.year("Date").alias("Year"), F.month("Date").alias("Month"),
                    F.dayofmonth("Date").alias("Day"),
                    (F.col("ta") - 6).alias("Temp_low"), F.col("ta").alias("Temp_avg"),
                    (F.col("ta") + 6).alias("Temp_high"), F.col("rh").alias("Rel_Humidity_avg"),
                    X.abs_humidity(F.col("ta"), F.col("rh")).alias("Abs_Humidity_avg")))


def site_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather of each nation's suppliers as a site of its own; many days are missing."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("Site"))
    daily = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", ship_date().alias("Date")).agg(
        F.sum("l_quantity").alias("q"), F.sum("l_linenumber").alias("n"), F.count(F.lit(1)).alias("c"))
    daily = daily.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("Site", "Date").agg(
        F.sum("q").alias("q"), F.sum("n").alias("n"), F.sum("c").alias("c"))
    ta, rh = F.round(F.col("q") / F.col("c") - 15, 2), F.round(F.lit(60) + F.col("n") / F.col("c") * 4, 2)
    return (daily.select("Site", "Date", ta.alias("ta"), rh.alias("rh")).select(
        "Site", "Date", (F.col("ta") - 6).alias("Temp_low"), F.col("ta").alias("Temp_avg"), (F.col("ta") + 6).alias("Temp_high"),
        F.col("rh").alias("Rel_Humidity_avg"), X.abs_humidity(F.col("ta"), F.col("rh")).alias("Abs_Humidity_avg")))


def raw_animals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven leading text columns of every farm-year sheet, with its usual dirt:
    mixed-case codes, inner spaces, "<1" ages, blank risks and averages, and (for checks)
    some unknown codes, unknown fields and non-numeric ages."""
    key = F.col("s_suppkey")
    base = with_years(_supplier_place(spark, sf_dir), spark, sf_dir)
    age = key % 30 + (F.col("Year") - 1995)
    return base.select(
        "Farm", "Year", F.concat(F.lit("S "), key.cast("string")).alias("Name"),
        F.concat(F.lit("T"), key.cast("string")).alias("Tag"),
        F.when(key % 41 == 0, "XX").when(key % 3 == 0, "dkf").when(key % 3 == 1, " dkg")
        .otherwise("Hy F").alias("Sex"),
        F.when(key % 43 == 0, "old").when(age < 1, "<1").otherwise(age.cast("string")).alias("Age"),
        F.when(key % 47 == 0, "Back Field").otherwise(F.col("Field")).alias("Location"),
        F.when(key % 53 == 0, "severe").when(key % 20 == 0, "Very High")
        .when(key % 7 == 0, " high").when(key % 2 == 0, "Normal").alias("ClinicalRisk"),
        F.when(F.col("s_acctbal") > 0, (F.floor(F.col("s_acctbal") * 10) / 100).cast("string"))
        .otherwise("").alias("AvFEC"))


WEEKS = tuple(range(0, 54))


def wide_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All farm-year sheets in wide form (one row per animal, F0..F53 and T0..T53 as text)."""
    ani = animal(spark, sf_dir)
    facts = weekly_counts(spark, sf_dir)
    # dealt by sheet row first: else every week is sent, and sorted again, as a row of 108 columns
    cells = (facts.repartition("AnimalID", "Location", "Year")
             .groupBy("AnimalID", "Location", "Year").pivot("Week", list(WEEKS))
             .agg(F.first(F.col("FEC").cast("string")).alias("F"),
                  F.first("DoseText").alias("T")))
    names = {f"{w}_{k}": f"{k}{w}" for w in WEEKS for k in ("F", "T")}
    cells = cells.withColumnsRenamed(names)
    return (ani.join(cells, ["AnimalID", "Location", "Year"])
            .select("Farm", "Year", F.regexp_replace("AnimalID", "^.*_", "").alias("Name"), "Tag",
                    "Sex", F.col("Age").cast("string").alias("Age"),
                    F.col("Field").alias("Location"), "ClinicalRisk",
                    F.col("AvFEC").cast("string").alias("AvFEC"),
                    F.concat(F.lit("note "), "Tag").alias("Notes"),
                    *[f"{k}{w}" for w in WEEKS for k in ("F", "T")]))


def hourly_readings(spark: SparkSession, sf_dir: str, unit: str = "day") -> DataFrame:
    """One row per day (or first day of a longer unit) with an array of readings in Kelvin.

    The day's rows are first averaged per line number (1..7), so an array never holds more
    than seven readings however many rows a day has.
    """
    slots = (table(spark, sf_dir, "lineitem")
             .groupBy(F.trunc(ship_date(), unit).alias("date") if unit != "day" else ship_date().alias("date"), "l_linenumber")
             .agg(F.avg("l_quantity").alias("q")))
    temp = F.col("q") / 2 + 265
    reading = F.struct(temp.alias("temp"), F.lit(0.0).alias("humidity"),
                       (temp - F.col("l_linenumber")).alias("dew_point"))
    return slots.groupBy("date").agg(F.collect_list(reading).alias("hourly"))


def pm_coefficients(spark: SparkSession) -> DataFrame:
    """Demographic model: our own fixed estimates, in the required term order."""
    from herdcast.schema import PM_TERMS
    values = (-0.4, 0.9, 0.1, 0.3, 0.0, -0.2, 0.15, 1.2, 0.0, -0.1, 0.25)
    return spark.createDataFrame(list(zip(PM_TERMS, values)), "term string, estimate double")


PM_THRESHOLD = 0.6
