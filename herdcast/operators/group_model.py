"""The location-week model: formula terms to columns, the fit, its refits, its predictions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdcast.operators import arrow as ar
from herdcast.operators import mixed as mx
from herdcast.schema import HYGIENE_LEVELS, ModelSpec, Options
from herdcast.session import materialise


def level_counts(df: DataFrame, col: str, declared: Sequence[str] = ()) -> list[str]:
    """Levels of a factor, the most frequent first (ties: first declared) and the rest in order."""
    rows = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r[0]: r[1] for r in rows}
    if not counts:
        return []
    place = {v: i for i, v in enumerate(declared)}
    top = min(counts, key=lambda v: (-counts[v], place.get(v, len(place)), v))
    return [top] + sorted(v for v in counts if v != top)


def expand_terms(terms: Sequence[str], levels: dict[str, list[str]]) -> dict[str, Column]:
    """Formula terms to named design columns, intercept first.

    A level that ``levels`` does not name makes the intercept null, and with it any prediction.
    """
    known = F.lit(True)
    for name in (m.group(1) for t in terms if (m := re.fullmatch(r"factor\((\w+)\)", t))):
        known = known & F.col(name).isin(levels[name])
    out = {"(Intercept)": F.when(known, F.lit(1.0))}
    for term in terms:
        if m := re.fullmatch(r"factor\((\w+)\)", term):
            name = m.group(1)
            for level in levels[name][1:]:
                out[f"{name}{level}"] = (F.col(name) == level).cast("double")
        elif m := re.fullmatch(r"log\((\w+)\)", term):
            out[term] = F.log(F.col(m.group(1)))
        elif m := re.fullmatch(r"(\w+)\^2/(\d+)", term):
            c = F.col(m.group(1)).cast("double")
            out[f"I({term})"] = c * c / int(m.group(2))
        elif re.fullmatch(r"\w+", term):
            out[term] = F.col(term).cast("double")
        else:
            raise ValueError(f"unknown term {term}")
    return out


FARM_TERM = "factor(Farm)"


@dataclass
class GroupFit:
    """Whole-data fit, and where the per-farm-year refits live.

    ``design`` and ``fit.beta`` hold the intercept and all terms but the farms, which are kept apart as ``farms``
    (effect relative to the reference farm; None without farms in the formula).
    """

    design: dict[str, Column]
    fit: mx.Fit
    folds: DataFrame            # Farm, Year, beta (original scale), farm_effect, year_effect, ...
    levels: dict[str, list[str]]
    means: dict[str, float]     # averages used by the prediction grid
    farms: dict[str, float] | None
    terms: Sequence[str]
    every_farm: Callable[[], DataFrame] | None = None       # Farm, Year, term, estimate: farm terms of all refits

    @property
    def names(self) -> list[str]:
        """All coefficients in the order of the formula."""
        return list(expand_terms(self.terms, self.levels))

    @property
    def coefficients(self) -> dict[str, float]:
        known = dict(zip(self.design, self.fit.beta.tolist()))
        known |= {f"Farm{k}": v for k, v in (self.farms or {}).items()}
        return {n: known[n] for n in self.names}


def _standardise(rows: DataFrame, names: Sequence[str], extra: dict[str, Column]) -> dict:
    aggs = [F.avg(c).alias(f"m_{i}") for i, c in enumerate(names)]
    aggs += [F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(names)]
    return rows.agg(*aggs, *[c.alias(k) for k, c in extra.items()]).first().asDict()


def fit_group_model(group: DataFrame, spec: ModelSpec = ModelSpec(), options: Options = Options()
                    ) -> GroupFit:
    """REML fit of mean log counts with weights, and every farm-year exclusion refit.

    Farms are a block of any size (:mod:`arrow`): they come before the other terms where terms depend on each
    other. ``group`` should be written: it is read by the level count, the scaling pass and the two passes of sums.
    """
    levels = {"Hygiene": [h for h in HYGIENE_LEVELS if h in level_counts(group, "Hygiene")]}
    for term in spec.terms:
        m = re.fullmatch(r"factor\((\w+)\)", term)
        if m and m.group(1) not in levels:
            levels[m.group(1)] = level_counts(group, m.group(1))
    blocks = FARM_TERM in spec.terms
    design = expand_terms([t for t in spec.terms if t != FARM_TERM], levels)
    names = list(design)
    rows = (group.filter(F.col("TotalFEC") >= options.min_n)
            .select("Farm", "Year", "LocationYear", F.col("TotalFEC").cast("double").alias("w"),
                    *[c.alias(f"x{i}") for i, c in enumerate(design.values())],
                    F.col("meanLogFEC").alias("y"))
            .dropna().persist())
    xs = [f"x{i}" for i in range(len(names))]
    stats = _standardise(rows, [*xs, "y"], {
        "weight": F.sum("w"), "groups": F.count_distinct("LocationYear"), "n": F.count(F.lit(1)),
        "years": F.array_sort(F.collect_set("Year")), "farms": F.count_distinct("Farm")})
    if not stats["n"]:
        raise ValueError(f"no location-week has {options.min_n} counts and complete covariates")
    k = len(xs)
    mean = np.array([stats[f"m_{i}"] for i in range(k + 1)])
    scale = np.array([stats[f"s_{i}"] or 1.0 for i in range(k + 1)])
    mean[0], scale[0], scale[k] = 0.0, 1.0, 1.0
    z = [((F.col(c) - float(mean[i])) / float(scale[i])).alias(c) for i, c in enumerate([*xs, "y"])]
    std = rows.select("Farm", "Year", "LocationYear", "w", *z)
    # the farms' effects take the place of the intercept
    used = [*xs[1:], "y"] if blocks else [*xs, "y"]
    layout = ar.Layout(mx.chebyshev_nodes(stats["weight"] / stats["groups"]), tuple(stats["years"]), len(used), blocks)
    sums = ar.pieces(std, used, F.col("w"), "LocationYear")
    total = ar.total_sums(sums, layout)
    options_ = spec.random_location_year, spec.random_year
    raw = ar.Arrow(total, layout, *options_).optimum()
    farms, anchors = None, []
    fit = mx.Fit(raw.beta.copy(), raw.sigma2, raw.ratio_group, raw.ratio_year, raw.year_effect, raw.criterion)
    if blocks:
        effects = {r["Farm"]: r["effect"] for r in ar.block_effects(sums, raw, layout).collect()}
        # the intercept is the first level's, or the last one's where the first has no usable row
        anchors = [f for f in (levels["Farm"][0], *reversed(levels["Farm"][1:])) if f in effects][:2]
        base = effects.pop(anchors[0])
        farms = {f: effects[f] - base if f in effects else float("nan") for f in levels["Farm"]} | {levels["Farm"][0]: 0.0}
        fit.beta = np.append(base, fit.beta)
    folds = ar.fit_excluding(sums, total, raw, layout, *options_, anchors)
    slopes = fit.beta[1:] / scale[1:k]
    shift = float(np.nansum(slopes * mean[1:k]))
    fit.beta = np.append(fit.beta[0] + mean[k] - shift, slopes)
    folds = materialise(folds, "refits")                    # on the scaled terms, as the farms' effects are made from them
    for held in (rows, sums.stream):
        held.unpersist()

    def original(beta: Column) -> Column:
        first = F.col("anchor_effect") if blocks else beta[0]
        parts = [beta[j - blocks] / F.lit(float(scale[j])) for j in range(1, k)]
        shifted = sum((F.coalesce(b * F.lit(float(m)), F.lit(0.0)) for b, m in zip(parts, mean[1:k])), F.lit(0.0))
        return F.array(first + F.lit(float(mean[-1])) - shifted, *parts)

    effect = F.when(F.col("Farm") == F.col("anchor"), F.lit(0.0)).otherwise(F.col("own_effect") - F.col("anchor_effect"))
    known = folds.select("Farm", "Year", original(F.col("beta")).alias("beta"), (effect if blocks else F.lit(0.0)).alias("farm_effect"),
                         "year_effect", "sigma2", "ratio_group", "ratio_year")
    weather = [c for c in group.columns if re.match(r"(Temp|RelHumid|AbsHumid)_", c)]
    # written, so that its size is known where the individual rows are joined to it
    every = materialise(_every_fold(group, known, fit, farms), "folds")
    means = group.agg(F.avg("TotalAnimals").alias("TotalAnimals"),
                      *[F.avg(c).alias(c) for c in weather]).first().asDict()
    return GroupFit(design, fit, every, levels, means, farms, spec.terms,
                    (lambda: ar.every_block_effect(sums, folds, layout, levels["Farm"])) if blocks else None)


def stored_group_fit(group: DataFrame, coefficients: dict[str, float], levels: dict[str, list[str]],
                     terms: Sequence[str] = ModelSpec().terms) -> GroupFit:
    """A fit made of stored coefficients, to predict with; every farm-year of ``group`` has them in place of a refit.

    ``levels`` gives each factor's levels, the reference first, which a list of coefficients does not name. The stored
    names have to be those of the formula. A missing value is a term that was left out. There are no random effects.
    """
    names = list(expand_terms(terms, levels))
    if set(names) != set(coefficients):
        odd = sorted(set(names) ^ set(coefficients))
        raise ValueError(f"coefficients and formula differ in {odd[0]}")
    design = expand_terms([t for t in terms if t != FARM_TERM], levels)
    beta = np.array([np.nan if coefficients[n] is None else coefficients[n] for n in design], float)
    farms = None
    if FARM_TERM in terms:
        known = {f: coefficients[f"Farm{f}"] for f in levels["Farm"][1:]}
        farms = {levels["Farm"][0]: 0.0} | {f: float("nan") if v is None else v for f, v in known.items()}
    fit = mx.Fit(beta, float("nan"), 0.0, 0.0, {}, float("nan"))
    none = group.sparkSession.createDataFrame([], "Farm string, Year int, beta array<double>, farm_effect double, year_effect double, "
                                              "sigma2 double, ratio_group double, ratio_year double")
    weather = [c for c in group.columns if re.match(r"(Temp|RelHumid|AbsHumid)_", c)]
    means = group.agg(*[F.avg(c).alias(c) for c in ("TotalAnimals", *weather)]).first().asDict()
    # a farm without a stored level has no fold, and so no prediction
    own = group if farms is None else group.join(_farm_table(group, farms).select("Farm"), "Farm", "left_semi")
    return GroupFit(design, fit, _every_fold(own, none, fit, farms), levels, means, farms, terms)


def _every_fold(group: DataFrame, folds: DataFrame, fit: mx.Fit, farms: dict[str, float] | None) -> DataFrame:
    """A fold for every farm-year of the frame: one without a usable row leaves nothing out."""
    effect = F.lit(0.0)
    for year, value in fit.year_effect.items():
        effect = F.when(F.col("Year") == F.lit(year), F.lit(value)).otherwise(effect)
    every = group.select("Farm", "Year").where("Farm IS NOT NULL AND Year IS NOT NULL").distinct()
    whole = {"beta": F.array(*[F.lit(None if np.isnan(b) else float(b)).cast("double") for b in fit.beta]), "year_effect": effect,
             "sigma2": F.lit(float(fit.sigma2)), "ratio_group": F.lit(float(fit.ratio_group)), "ratio_year": F.lit(float(fit.ratio_year))}
    if farms is not None:
        every = every.join(_farm_table(group, farms), "Farm", "left")
        whole["farm_effect"] = F.col("_whole")
        # a farm that a refit does not know stays without an effect of its own
        folds = folds.withColumn("_refit", F.lit(True))
        joined = every.join(folds, ["Farm", "Year"], "left")
        out = joined.withColumns({c: F.coalesce(c, v) if c != "farm_effect" else F.when(F.col("_refit"), F.col(c)).otherwise(v) for c, v in whole.items()})
        return out.drop("_whole", "_refit")
    return every.join(folds, ["Farm", "Year"], "left").withColumns(
        {c: F.coalesce(c, v) for c, v in (whole | {"farm_effect": F.lit(0.0)}).items()})


def _farm_table(df: DataFrame, farms: dict[str, float]) -> DataFrame:
    """(Farm, _whole): the farms' effects, null where there is none."""
    rows = [(f, None if v != v else v) for f, v in farms.items()]
    return df.sparkSession.createDataFrame(rows, "Farm string, _whole double")


def _dot(design: dict[str, Column], coef) -> Column:
    total = F.lit(0.0)
    for i, x in enumerate(design.values()):
        total = total + coef(i) * x
    return total


def predict_single(df: DataFrame, g: GroupFit, name: str, year: bool = False) -> DataFrame:
    """``name``: fixed effects of the whole-data fit, plus the known year's effect if asked.

    A row of a farm, or of another level, that the fit does not know has no prediction.
    """
    beta = np.nan_to_num(g.fit.beta)
    out = _dot(g.design, lambda i: F.lit(float(beta[i])))
    if year and g.fit.year_effect:
        effect = None
        for y, e in g.fit.year_effect.items():
            hit = F.col("Year") == F.lit(y)
            effect = F.when(hit, F.lit(e)) if effect is None else effect.when(hit, F.lit(e))
        out = out + effect.otherwise(F.lit(0.0))
    if g.farms is None:
        return df.withColumn(name, out)
    known = {f: 0.0 if v != v else v for f, v in g.farms.items()}
    return df.join(_farm_table(df, known), "Farm", "left").withColumn(name, out + F.col("_whole")).drop("_whole")


def predict_excluded(df: DataFrame, g: GroupFit, name: str, without_doses: str | None = None
                     ) -> DataFrame:
    """Predict every row from the refit that left its own farm-year out.

    The location effect is never used; the year effect is, as far as other farms inform it.
    ``without_doses`` names a second prediction with the treatment terms set to zero.
    """
    folds = g.folds.select("Farm", "Year", F.col("beta").alias("_beta"),
                           (F.col("year_effect") + F.coalesce("farm_effect", F.lit(0.0))).alias("_ye"))
    out = df.join(folds, ["Farm", "Year"], "left")

    def dot(design: dict[str, Column]) -> Column:
        # over arrays: written out, the terms make a method too long for the JVM to compile
        parts = F.zip_with(F.array(*design.values()), "_beta", lambda x, b: F.coalesce(b, F.lit(0.0)) * x)
        return F.aggregate(parts, F.lit(0.0), lambda a, v: a + v)
    known = F.col("_beta").isNotNull()
    cols = {name: F.when(known, dot(g.design) + F.col("_ye"))}
    if without_doses:
        rest = {k: (F.lit(0.0) if k.startswith("DoseProp") else c) for k, c in g.design.items()}
        cols[without_doses] = F.when(known, dot(rest) + F.col("_ye"))
    return out.withColumns(cols).drop("_beta", "_ye")


def fold_coefficients(g: GroupFit) -> DataFrame:
    """Long table of the refits: farm, year, ord, term, estimate (null where dropped)."""
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in g.design]).alias("term"), "beta")
    long = (g.folds.select("Farm", "Year", F.explode(pairs).alias("p"))
            .select("Farm", "Year", F.col("p.term").alias("term"), F.col("p.beta").alias("estimate")))
    if g.every_farm is not None:
        long = long.unionByName(g.every_farm())
    order = g.folds.sparkSession.createDataFrame(list(enumerate(g.names)), "ord int, term string")
    return long.join(order, "term").select("Farm", "Year", "ord", "term", "estimate")


def prediction_grid(g: GroupFit, dims: DataFrame, rolling: DataFrame | None) -> DataFrame:
    """Seasonal curve per farm, hygiene, year and week for an average untreated herd.

    With ``rolling`` the curve follows the real weather; without it, average weather.
    """
    from herdcast.functions import expr as X
    from herdcast.operators.joins import season_grid
    grid = season_grid(dims)
    if rolling is not None:
        grid = grid.join(rolling, ["Year", "Week"], "left")
    else:
        grid = grid.withColumns({c: F.lit(v) for c, v in g.means.items() if c != "TotalAnimals"})
    grid = grid.withColumns({
        "DoseProp4": F.lit(0.0), "DoseProp8": F.lit(0.0), "DoseProp12": F.lit(0.0),
        "MeanAge": F.lit(15.0), "TotalAnimals": F.lit(g.means["TotalAnimals"]),
        "FarmHygiene": F.concat_ws("_", "Farm", "Hygiene"),
        "sdoy": X.sdoy(F.col("Week")), "cdoy": X.cdoy(F.col("Week"))})
    grid = predict_excluded(predict_single(grid, g, "pred_single", year=True), g, "pred_exclusion")
    return grid.select("Farm", "Hygiene", "Year", "Week",
                       F.exp("pred_exclusion").alias("PredExclusion"),
                       F.exp("pred_single").alias("PredSingle"))
