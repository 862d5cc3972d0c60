"""Table schemas, declared level lists and option records.

Every table is an ordinary DataFrame with one of these ``StructType``s. Factor-like
columns are strings plus a declared level list: the list fixes the order of dummy
coding, while the reference level is chosen from the data (``reference_level``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: category levels -----------------------------------------------
HYGIENE_LEVELS = ("None", "Automated", "Manual")
SEX_LEVELS = ("DKF", "DKM", "MUPY")
AGE_LEVELS = ("Age_0-5", "Age_6-10", "Age_11-20", "Age_21+")
RISK_LEVELS = ("Normal", "High", "VeryHigh")
DOSE_CAT_LEVELS = (">12", "1-4", "5-8", "9-12")

# --- fixed values: sex codes accepted on a sheet and the category each one means ---
SEX_CODES = {
    "DKF": "DKF", "DKM": "DKM", "DKG": "DKM", "DG": "DKM", "DKS": "DKM", "DK(RIG)": "DKM",
    "PYF": "MUPY", "MUF": "MUPY", "PYG": "MUPY", "MUG": "MUPY", "MUS": "MUPY", "POG": "MUPY",
    "POF": "MUPY", "HOF": "MUPY", "HYF": "MUPY", "HYG": "MUPY", "HYS": "MUPY", "HOG": "MUPY",
    "MUPY": "MUPY",
}

# --- fixed values: drug abbreviations ----------------------------------------------
DRUG_CODES = ("MOX", "FBZ", "IVM", "PYR")

# --- fixed values: required columns --------------------------------------------------
SHEET_FIRST_COLUMNS = ("Name", "Tag", "Sex", "Age", "Location", "ClinicalRisk", "AvFEC")
LOCATION_COLUMNS = ("Farm", "Location", "Hygiene", "Sensitivity")
WEATHER_MEASURES = ("Temp_high", "Temp_avg", "Temp_low", "Rel_Humidity_avg", "Abs_Humidity_avg")
WEATHER_COLUMNS = ("Year", "Week", "Month", "Day") + WEATHER_MEASURES

# --- fixed values: terms of the demographic risk model, in their fixed order --------------
PM_TERMS = (
    "PM_Intercept", "PM_AgeCatAge_0-5", "PM_AgeCatAge_11-20", "PM_AgeCatAge_21+",
    "PM_AgeCatAge_6-10", "PM_cdoy", "PM_sdoy", "PM_I(meanFEC/1000)",
    "PM_SexDKF", "PM_SexDKM", "PM_SexMUPY",
)

# --- fixed values: rolling weather offsets in weeks ----------------------------------------
WEATHER_LAGS = (0, 4, 8, 12, 16, 20, 24)

_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


LOCATIONS = _schema(("Year", _I), ("Farm", _S), ("Field", _S), ("Location", _S),
                    ("Hygiene", _S), ("Sensitivity", _D))
ANIMAL = _schema(("Year", _I), ("Farm", _S), ("Location", _S), ("Field", _S), ("AnimalID", _S),
                 ("Tag", _S), ("Sex", _S), ("Age", _D), ("AgeCat", _S), ("AvFEC", _D),
                 ("ClinicalRisk", _S))
FEC = _schema(("AnimalID", _S), ("Location", _S), ("Year", _I), ("Week", _I), ("FEC", _D),
              ("Count", _D), ("Dose", _B), ("DoseText", _S), ("Monday", T.DateType()),
              ("LastDose", _D))
WEATHER = _schema(("Date", T.DateType()), ("Year", _I), ("Month", _I), ("Day", _I),
                  ("Temp_low", _D), ("Temp_avg", _D), ("Temp_high", _D),
                  ("Rel_Humidity_avg", _D), ("Abs_Humidity_avg", _D))
HOURLY = _schema(
    ("date", T.DateType()),
    ("hourly", T.ArrayType(_schema(("temp", _D), ("humidity", _D), ("dew_point", _D)))),
)

TABLES = {"Locations": LOCATIONS, "Animal": ANIMAL, "FEC": FEC, "Weather": WEATHER}
KEYS = {
    "Locations": ("Farm", "Location", "Year"),
    "Animal": ("Farm", "Location", "AnimalID", "Year"),
    "FEC": ("Location", "AnimalID", "Monday"),
    "Weather": ("Date",),
}


@dataclass(frozen=True)
class Options:
    """Run options, passed as an argument instead of living in global state."""

    min_n: int = 10
    expected_efficacy: float = 0.95
    min_week: int = 12
    max_week: int = 48
    sex_codes: dict[str, str] = field(default_factory=lambda: dict(SEX_CODES), hash=False)
    drug_codes: tuple[str, ...] = DRUG_CODES
    fix_dose12: bool = False
    subtract_one: bool = True

    def __post_init__(self) -> None:
        if not 0 < self.expected_efficacy < 1:
            raise ValueError("expected_efficacy must lie strictly between 0 and 1")
        if min(self.min_n, self.min_week, self.max_week) <= 0:
            raise ValueError("min_n, min_week and max_week must be positive")


# A formula term is a column name, "log(x)", "x^2/10" or a factor written "factor(x)".
DEFAULT_TERMS = (
    "factor(Farm)", "factor(Hygiene)", "log(TotalAnimals)",
    "DoseProp4", "DoseProp8", "DoseProp12",
    "Temp_avg_16", "Temp_avg_16^2/10", "Temp_avg_20", "Temp_avg_20^2/10",
    "AbsHumid_16", "AbsHumid_16^2/10", "AbsHumid_20", "AbsHumid_20^2/10",
    "Temp_frost_8", "Temp_frost_8^2/10", "Temp_frost_12", "Temp_frost_12^2/10",
    "Temp_frost_16", "Temp_frost_16^2/10", "sdoy", "cdoy",
)


@dataclass(frozen=True)
class ModelSpec:
    """What to fit: group formula terms, random intercepts and the backfit switches."""

    terms: tuple[str, ...] = DEFAULT_TERMS
    random_year: bool = True
    random_location_year: bool = True
    txtime: int = 0
    txrm: bool = False
    lastyear: bool = True
    individual_intercept: bool = False
    resid_doy_interaction: bool = False
    common_re: bool = True
    use_location_offsets: bool = False
    maxiters: int = 1000
    tol: float = 1e-3

    def __post_init__(self) -> None:
        if self.txtime not in (0, 8, 12):
            raise ValueError("txtime must be 0, 8 or 12")
