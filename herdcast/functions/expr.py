"""Scalar column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from herdcast.schema import SEX_CODES

INF = float("inf")


def band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge[i], edge[i+1]]``; values outside every bin give null."""
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > F.lit(low)) & (value <= F.lit(high))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def age_band(age: Column) -> Column:
    return band(age, (-1.0, 5.5, 10.5, 20.5, 100.0),
                ("Age_0-5", "Age_6-10", "Age_11-20", "Age_21+"))


def last_dose_category(weeks: Column) -> Column:
    return band(weeks, (0.5, 4.5, 8.5, 12.5, INF), ("1-4", "5-8", "9-12", ">12"))


def strip_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"\s", "")


def make_key(*parts: Column) -> Column:
    """Compound text key without any white space: farm_name, farm_field."""
    return strip_spaces(F.concat_ws("_", *parts))


def recode_sex(code: Column, codes: dict[str, str] = SEX_CODES) -> Column:
    """Upper-case, space-free code looked up in the code table; unknown codes give null."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.try_element_at(table, F.upper(F.regexp_replace(code, " ", "")))


def recode_risk(text: Column) -> Column:
    clean = F.coalesce(F.lower(F.regexp_replace(text, " ", "")), F.lit("normal"))
    return (F.when(clean == "normal", "Normal").when(clean == "high", "High")
            .when(clean == "veryhigh", "VeryHigh"))


def parse_number(text: Column) -> Column:
    """Text to double, null when it does not parse (never raises under ANSI mode)."""
    return F.trim(text).try_cast("double")


def parse_age(text: Column) -> Column:
    return parse_number(F.when(text == "<1", F.lit("0")).otherwise(text))


def contains_drug(text: Column, drugs: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(d)) for d in drugs])


def sdoy(week: Column) -> Column:
    return F.sin(week * F.lit(2 * math.pi) / 52)


def cdoy(week: Column) -> Column:
    return F.cos(week * F.lit(2 * math.pi) / 52)


def dose_prop_group(total: Column, dosed: Column, efficacy: float) -> Column:
    """Log of the expected remaining share of the mean when ``dosed`` of ``total`` were treated."""
    red = 1 - efficacy
    return F.log((total - dosed) / total + F.lit(red) * dosed / total)


def dose_prop_individual(last_dose: Column, efficacy: float,
                         fix_dose12: bool = False) -> dict[str, Column]:
    """0 or log(1 - efficacy) for the 4, 8 and 12 week bands of one animal.

    The 12 week band leaves out only the 8 week band, so an animal treated within four
    weeks is in it as well; ``fix_dose12`` makes the three bands disjoint.
    """
    hit = F.lit(math.log(1 - efficacy))
    d4 = last_dose <= 4
    d8 = (last_dose <= 8) & ~d4
    d12 = (last_dose <= 12) & ~d8
    if fix_dose12:
        d12 = d12 & ~d4
    return {f"DoseProp{k}": F.when(c, hit).otherwise(F.lit(0.0))
            for k, c in ((4, d4), (8, d8), (12, d12))}


def rel_humidity(temp_c: Column, dew_c: Column) -> Column:
    """Relative humidity (%) from temperature and dew point (Magnus form)."""
    def sat(t: Column) -> Column:
        return F.exp(t * 17.625 / (t + 243.04))
    return sat(dew_c) / sat(temp_c) * 100


def abs_humidity(temp_c: Column, rh: Column) -> Column:
    """Absolute humidity (g/m3) from temperature and relative humidity."""
    return (F.lit(6.112) * F.exp(temp_c * 17.67 / (temp_c + 243.5)) * rh * 2.1674
            / (temp_c + 273.15))


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


# Rational approximation of the normal tail (Hart 1968, as given by West 2005).
_TAIL_NUM = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
             112.079291497871, 221.213596169931, 220.206867912376)
_TAIL_DEN = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
             296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def _horner(coefs: Sequence[float], x: Column) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefs[1:], F.lit(coefs[0]))


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function as plain column arithmetic (error below 1e-14)."""
    a = F.abs(x)
    gauss = F.exp(-a * a / 2)
    frac = a + 0.65
    for k in (4, 3, 2, 1):
        frac = a + F.lit(float(k)) / frac
    upper = (F.when(a > 37, F.lit(0.0))
             .when(a < 7.07106781186547, gauss * _horner(_TAIL_NUM, a) / _horner(_TAIL_DEN, a))
             .otherwise(gauss / frac / math.sqrt(2 * math.pi)))
    return F.when(x > 0, F.lit(1.0) - upper).otherwise(upper)


def threshold_probability(mean: Column, threshold: float, sd: float | Column) -> Column:
    """P(count > threshold) for a log-scale normal with mean ``mean`` and deviation ``sd``."""
    return F.lit(1.0) - normal_cdf((F.lit(math.log(threshold + 1)) - mean) / sd)
