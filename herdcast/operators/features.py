"""Model frames: location-week summaries and individual rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdcast.functions import expr as X
from herdcast.operators import lags as L
from herdcast.schema import Options
from herdcast.session import materialise


def season(options: Options) -> Column:
    """Rows of the modelled season: a plain predicate, pushed to the scan."""
    return (F.col("Week").between(options.min_week, options.max_week)
            & F.col("Location").isNotNull() & F.col("FEC").isNotNull())


def filter_season(fec: DataFrame, options: Options = Options()) -> DataFrame:
    return fec.filter(season(options))


def filter_years(fec: DataFrame, as_of_year: int, n_years: int = 11) -> DataFrame:
    """The ``n_years`` years before ``as_of_year`` (as far as they are on record)."""
    return fec.filter(F.col("Year").between(as_of_year - n_years, as_of_year - 1))


def group_week_summary(fec: DataFrame, options: Options = Options()) -> DataFrame:
    """Per location-week: mean log count, number counted, numbers in the treatment bands."""
    dose = F.col("LastDose")
    within = {k: F.count_if(dose <= k) for k in (4, 8, 12)}
    return (filter_season(fec, options)
            .groupBy("Location", "Year", "Week", "Monday")
            .agg(F.avg(F.log1p("FEC")).alias("meanLogFEC"),
                 F.count(F.lit(1)).alias("TotalFEC"),
                 within[4].alias("DosedWithin4"),
                 (within[8] - within[4]).alias("DosedWithin8"),
                 (within[12] - within[8]).alias("DosedWithin12")))


def location_summary(animal: DataFrame, locations: DataFrame) -> DataFrame:
    """Mean age and number of animals per location-year.

    Animals are aggregated before the site dimension is joined.
    """
    per = (animal.filter(F.col("Location").isNotNull()).groupBy("Farm", "Location", "Year")
           .agg(F.avg("Age").alias("MeanAge"), F.count(F.lit(1)).alias("TotalAnimals")))
    dim = locations.select("Farm", "Location", "Year", "Hygiene", "Sensitivity")
    return per.join(dim, ["Farm", "Location", "Year"], "left").select(
        "Farm", "Location", "Year", "Hygiene", "Sensitivity", "MeanAge", "TotalAnimals")


def with_season_terms(df: DataFrame) -> DataFrame:
    return df.withColumns({"sdoy": X.sdoy(F.col("Week")), "cdoy": X.cdoy(F.col("Week"))})


def with_group_doses(df: DataFrame, options: Options = Options()) -> DataFrame:
    total = F.col("TotalAnimals")
    return df.withColumns({
        f"DoseProp{k}": X.dose_prop_group(total, F.col(f"DosedWithin{k}"),
                                          options.expected_efficacy) for k in (4, 8, 12)})


def group_rows(fec: DataFrame, animal: DataFrame, locations: DataFrame,
               options: Options = Options()) -> DataFrame:
    """Location-weeks joined to their location's summary (before weather)."""
    return with_season_terms(group_week_summary(fec, options).join(
        location_summary(animal, locations), ["Location", "Year"], "left"))


def group_model_data(fec: DataFrame, animal: DataFrame, locations: DataFrame, rolling: DataFrame,
                     options: Options = Options()) -> DataFrame:
    rows = with_group_doses(group_rows(fec, animal, locations, options), options)
    weather = [c for c in rolling.columns if c not in ("Year", "Week", "Monday")]
    return (rows.join(rolling, ["Year", "Week", "Monday"], "left")
            .select("meanLogFEC", "TotalFEC", "Year",
                    F.concat_ws("_", "Location", "Year").alias("LocationYear"), "Location",
                    F.concat_ws("_", "Farm", "Hygiene").alias("FarmHygiene"), "Monday", "Week",
                    "sdoy", "cdoy", "Farm", "Hygiene", "MeanAge", "TotalAnimals",
                    "DoseProp4", "DoseProp8", "DoseProp12", *weather))


def individual_rows(fec: DataFrame, animal: DataFrame, locations: DataFrame,
                    options: Options = Options()) -> DataFrame:
    """Counted animal-weeks of the season with animal, location and treatment attributes.

    The summary is written, so that its size is known: a few locations are then not met by a shuffle of all rows.
    """
    loc = materialise(location_summary(animal, locations), "summary")
    ani = animal.filter(F.col("Location").isNotNull()).drop("Field")
    rows = (filter_season(fec, options)
            .join(ani, ["AnimalID", "Location", "Year"], "left")
            .join(loc, ["Location", "Year", "Farm"], "left"))
    dose = F.col("LastDose")
    return with_season_terms(rows).withColumns({
        "LocationYear": F.concat_ws("_", "Location", "Year"),
        "FarmHygiene": F.concat_ws("_", "Farm", "Hygiene"),
        **X.dose_prop_individual(dose, options.expected_efficacy, options.fix_dose12),
        "LastDoseCat": X.last_dose_category(dose)})


def individual_model_data(fec: DataFrame, animal: DataFrame, locations: DataFrame,
                          rolling: DataFrame, options: Options = Options()) -> DataFrame:
    return individual_rows(fec, animal, locations, options).join(
        rolling, ["Year", "Week", "Monday"], "left")


def location_week_means(rows: DataFrame, prediction: str | None = None) -> DataFrame:
    """Mean log count (and mean group prediction) per location-week with the number counted."""
    aggs = [F.avg(F.log1p("FEC")).alias("GroupMean"), F.count(F.lit(1)).alias("NFEC")]
    if prediction:
        aggs.insert(1, F.avg(prediction).alias("GroupPrediction"))
    return rows.groupBy("Year", "Week", "Monday", "Farm", "Location").agg(*aggs)


def history_features(rows: DataFrame, lastyear: bool = True) -> DataFrame:
    """Individual rows with their own lags and last-year mean; incomplete rows are left out."""
    out = L.history_lags(rows, last_year=True)
    out = out.dropna(subset=["FEC", "Sex", "AgeCat", "LastDose"])
    out = out.withColumns({"Obs": F.log1p("FEC"), "Tier": L.availability_tier(lastyear)})
    if lastyear:
        return out.filter(F.col("lastYearMeanFEC").isNotNull())
    return out.filter("Tier IN (4, 8, 12)")


def sampling_events(fec: DataFrame, animal: DataFrame, locations: DataFrame,
                    options: Options = Options()) -> DataFrame:
    """Distinct sampled location-weeks in season with the number of counts."""
    summary = location_summary(animal, locations).drop("Sensitivity")
    weekly = (filter_season(fec, options).groupBy("Location", "Year", "Week")
              .agg(F.count(F.lit(1)).alias("n")))
    return (weekly.join(summary, ["Location", "Year"])
            .filter(F.col("Hygiene").isNotNull())
            .select("Farm", "Location", "Year", "Hygiene", "Week", "n", "TotalAnimals", "MeanAge"))


def mean_group_size(group: DataFrame) -> DataFrame:
    return group.groupBy("Year", "Farm", "Location").agg(
        F.bround(F.avg("TotalFEC"), 1).alias("MeanTotalFEC"))


def hygiene_weekly_mean(fec: DataFrame, locations: DataFrame) -> DataFrame:
    return (fec.groupBy("Location", "Year", "Monday").agg(F.sum("FEC").alias("s"),
                                                         F.count("FEC").alias("n"))
            .join(locations.select("Location", "Year", "Hygiene"), ["Location", "Year"])
            .groupBy("Location", "Hygiene", "Monday")
            .agg((F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("meanCount")))


CENTRES = {"feclastyearmean": "lastYearMeanFEC", "fec4wkmean": "fec4wk", "fec8wkmean": "fec8wk",
           "fec12wkmean": "fec12wk", "res4mean": "residual_location4",
           "res8mean": "residual_location8", "res12mean": "residual_location12"}


def center_means(rows: DataFrame) -> DataFrame:
    """The global means used to centre the covariates (one row)."""
    present = {k: c for k, c in CENTRES.items() if c in rows.columns}
    return rows.agg(*[F.avg(c).alias(k) for k, c in present.items()])


def prev_season_average(sheet: DataFrame, id_cols: tuple[str, ...] = ("Farm", "Year", "Name", "Tag")
                        ) -> DataFrame:
    """Mean of last season's counts per sheet row; dead or never counted animals drop out.

    The count columns of a sheet are one row's cells, so the mean is an array expression
    and needs no shuffle.
    """
    import re
    counts = [c for c in sheet.columns if re.match(r"^F\d", c)]
    numbers = F.array_compact(F.array(*[X.parse_number(F.col(c)) for c in counts]))
    total = F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x)
    return (sheet.filter(F.col("Location") != "DEAD")
            .withColumn("AvFEC", F.bround(F.try_divide(total, F.size(numbers)), 0))
            .filter(F.col("AvFEC").isNotNull())
            .drop(*[c for c in sheet.columns if re.match(r"^[FT]\d", c)])
            .select(*id_cols, *[c for c in ("Sex", "Age", "Location", "ClinicalRisk", "Notes")
                                if c in sheet.columns], "AvFEC"))


def increment_age(rows: DataFrame) -> DataFrame:
    """Next season's sheet rows: a year older, blank risks Normal, notes moved aside."""
    return (rows.withColumn("Age", X.parse_age(F.col("Age")) + 1)
            .withColumn("ClinicalRisk", F.when(
                F.coalesce(F.col("ClinicalRisk"), F.lit("")) == "", "Normal")
                .otherwise(F.col("ClinicalRisk")))
            .withColumn("OldNotes", F.col("Notes")).withColumn("Notes", F.lit("")))
