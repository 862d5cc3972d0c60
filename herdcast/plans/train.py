"""Training: model frames, group model with refits, backfitted chain, dispersion."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdcast.operators import checks as C
from herdcast.operators import features as ft
from herdcast.operators import lags as L
from herdcast.operators import weather as wx
from herdcast.operators.backfit import DOSE_FLAGS, Backfit, fit_backfit, prepare_rows
from herdcast.operators.group_model import GroupFit, fit_group_model, predict_excluded
from herdcast.operators.negbin import NegBinFit, fit_dispersion, prepare
from herdcast.schema import ModelSpec, Options
from herdcast.session import materialise


@dataclass
class HerdTables:
    """The four conformed tables."""

    locations: DataFrame
    animal: DataFrame
    fec: DataFrame
    weather: DataFrame

    def years(self, years: Sequence[int]) -> HerdTables:
        pick = F.col("Year").isin(*years)
        return HerdTables(self.locations.filter(pick), self.animal.filter(pick),
                          self.fec.filter(pick), self.weather)


@dataclass
class FittedModels:
    group: GroupFit
    chain: Backfit
    dispersion: NegBinFit
    spec: ModelSpec
    options: Options
    group_data: DataFrame
    rolling: DataFrame
    rows: DataFrame
    every: DataFrame            # all individual rows with their predictions, the untrainable ones included


def validate_tables(tables: HerdTables) -> None:
    """The checks made before fitting: data present, years covered and consecutive."""
    for name in ("locations", "animal", "fec", "weather"):
        if getattr(tables, name).isEmpty():
            raise C.CheckFailed(f"no {name} rows have been loaded")
    C.require(C.year_coverage(tables.fec, {"Weather": tables.weather, "Animal": tables.animal,
                                           "Locations": tables.locations}), "year missing")
    C.require(C.year_span(tables.fec).filter("NOT ok"), "need two or more consecutive years")
    C.require(C.negative_counts(tables.fec), "negative count")


_WEATHER_USED = ("Temp_avg", "Temp_frost", "Temp_low", "RelHumid", "AbsHumid")


def _needed_weather(spec: ModelSpec, rolling: DataFrame) -> list[str]:
    text = " ".join(spec.terms)
    return [c for c in rolling.columns if c.startswith(_WEATHER_USED) and c in text]


def predicted_rows(tables: HerdTables, group: GroupFit, rolling: DataFrame, options: Options,
                   spec: ModelSpec) -> DataFrame:
    """Individual rows with the prediction of the refit that left their farm-year out."""
    weather = rolling.select("Year", "Week", "Monday", *_needed_weather(spec, rolling))
    rows = ft.individual_model_data(tables.fec, tables.animal, tables.locations, weather, options)
    rows = predict_excluded(rows, group, "GroupPredictionIncTx", "GroupPredictionNoTx")
    return rows.select("AnimalID", "Location", "Farm", "Year", "Week", "Monday", "FEC", "Count",
                       "Dose", "LastDose", "LastDoseCat", "Sex", "AgeCat", "Sensitivity",
                       "sdoy", "cdoy", "GroupPredictionIncTx", "GroupPredictionNoTx")


def location_history(rows: DataFrame) -> DataFrame:
    """Weighted predicted and observed means of each location's earlier weeks."""
    means = ft.location_week_means(rows, "GroupPredictionIncTx")
    lagged = L.lag_weighted_mean(means, {"loc_pred": "GroupPrediction", "loc_obs": "GroupMean"})
    return lagged.drop("GroupPrediction", "GroupMean", "NFEC", "Farm")


def training_rows(rows: DataFrame, spec: ModelSpec) -> DataFrame:
    own = ft.history_features(rows, spec.lastyear)
    out = own.filter(F.col("GroupPredictionNoTx").isNotNull())
    history = materialise(location_history(rows), "history")     # its size known, few location-weeks cost no shuffle of the rows
    return prepare_rows(out.join(history, ["Location", "Year", "Week", "Monday"], "left"), spec)


def fit_models(tables: HerdTables, spec: ModelSpec = ModelSpec(), options: Options = Options(),
               years: Sequence[int] | None = None, validate: bool = True, as_of_year: int | None = None,
               n_years: int = 11) -> FittedModels:
    """The whole chain, of the given ``years`` or of the ``n_years`` up to ``as_of_year``.

    Frames that several passes read (facts, location-weeks, individual rows) are written once
    to the shared folder; every pass over them is an aggregate whose result is a few small
    matrices.
    """
    if years is None and as_of_year is not None:
        years = range(as_of_year - n_years + 1, as_of_year + 1)
    if years is not None:
        tables = tables.years(years)
    if validate:
        validate_tables(tables)
    facts = materialise(ft.filter_season(tables.fec, options), "facts")
    tables = HerdTables(tables.locations, tables.animal, facts, tables.weather)
    rolling = materialise(wx.rolling_weather(tables.weather), "rolling")
    group_data = materialise(ft.group_model_data(facts, tables.animal, tables.locations, rolling,
                                                 options), "group")
    if validate:
        herd = ft.location_summary(tables.animal, tables.locations).select("Location", "Year", "TotalAnimals")
        weeks = ft.group_week_summary(facts).join(herd, ["Location", "Year"])
        C.require(C.group_invariants(weeks).select("Location", "Year", "Week"), "more animals counted or treated than there are")
    group = fit_group_model(group_data, spec, options)
    rows = materialise(predicted_rows(tables, group, rolling, options, spec), "rows")
    train = materialise(training_rows(rows, spec), "train")
    if spec.txtime and not spec.txrm:
        flags = DOSE_FLAGS[spec.txtime]
        C.require(C.dosing_leverage(train, list(flags.values())).filter("NOT ok"),
                  "too few treated or untreated rows")
    chain = fit_backfit(train, spec, rows)
    if not chain.converged:
        warnings.warn(f"the model did not converge in {chain.iterations} rounds", stacklevel=2)
    dispersion = fit_dispersion(prepare(train.withColumn("totpred", chain.total)))
    return FittedModels(group, chain, dispersion, spec, options, group_data, rolling, train, rows)


def compare_without_last_year(tables: HerdTables, spec: ModelSpec = ModelSpec(),
                              options: Options = Options()) -> tuple[FittedModels, FittedModels]:
    """The fit on all years and the fit without the last one (three years at least)."""
    span = C.year_span(tables.fec).first()
    if span["n_years"] < 3:
        raise C.CheckFailed("the comparison needs three years of data")
    every = fit_models(tables, spec, options)
    shorter = fit_models(tables, spec, options, range(span["first_year"], span["last_year"]))
    return every, shorter

