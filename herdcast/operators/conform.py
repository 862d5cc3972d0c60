"""From wide yearly sheets to animal rows and weekly count facts.

All farm-years are conformed in one job: Farm and Year are columns of the sheet frame.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdcast.functions import calendar as cal
from herdcast.functions import expr as X
from herdcast.schema import Options


def normalise_headers(names: Sequence[str | None]) -> list[str]:
    """Strip blanks, recognise the average-count column, number the unnamed columns."""
    clean = [None if n is None or not n.strip() else n.replace(" ", "") for n in names]
    averages = [i for i, n in enumerate(clean)
                if n is not None and "av" in n.lower() and "fec" in n.lower()]
    if len(averages) == 1:
        clean[averages[0]] = "AvFEC"
    elif "AvFEC" not in clean:
        raise ValueError("no column holding last year's average count was found")
    blanks = iter(range(1, len(clean) + 1))
    return [n if n is not None else f"blank{next(blanks)}" for n in clean]


def week_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if re.match(r"^[FT]\d", c)]


def week_offset(header: DataFrame) -> DataFrame:
    """Sheet week minus calendar week, from each sheet's row of dates.

    ``header`` has one row per farm-year with the F columns holding spreadsheet day
    serials as text; the first filled one is the reference.
    """
    cols = sorted((c for c in header.columns if re.match(r"^F\d", c)),
                  key=lambda c: int(c[1:]))
    first = F.coalesce(*[F.when(F.trim(F.col(c)) != "", F.struct(
        F.lit(int(c[1:])).alias("n"), X.parse_number(F.col(c)).alias("serial"))) for c in cols])
    date = F.date_add(F.lit("1899-12-30").cast("date"), F.col("ref.serial").cast("int"))
    return (header.select("Farm", "Year", first.alias("ref"))
            .select("Farm", "Year", date.alias("RefDate"),
                    (F.col("ref.n") - cal.week_w(date)).alias("WeekOffset")))


def conform_animals(sheet: DataFrame, locations: DataFrame, options: Options = Options()
                    ) -> DataFrame:
    """Animal dimension from the leading text columns; unknown locations become null."""
    known = locations.select("Farm", "Year", "Location", F.lit(True).alias("known"))
    age = X.parse_age(F.col("Age"))
    rows = sheet.select(
        "Year", "Farm", F.col("Location").alias("Field"),
        X.make_key(F.col("Farm"), F.col("Location")).alias("Location"),
        X.make_key(F.col("Farm"), F.col("Name")).alias("AnimalID"), "Tag",
        X.recode_sex(F.col("Sex"), options.sex_codes).alias("Sex"), age.alias("Age"),
        X.age_band(age).alias("AgeCat"), X.parse_number(F.col("AvFEC")).alias("AvFEC"),
        X.recode_risk(F.col("ClinicalRisk")).alias("ClinicalRisk"))
    return (rows.join(known, ["Farm", "Year", "Location"], "left")
            .select("Year", "Farm", F.when(F.col("known"), F.col("Location")).alias("Location"),
                    "Field", "AnimalID", "Tag", "Sex", "Age", "AgeCat", "AvFEC", "ClinicalRisk"))


def unpivot_weeks(sheet: DataFrame, ids: Sequence[str] = ("AnimalID", "Location", "Year")
                  ) -> DataFrame:
    """Wide F/T week columns to long (ids, Observation, Value)."""
    return sheet.unpivot(list(ids), week_columns(sheet.columns), "Observation", "Value")


def parse_observations(long: DataFrame, offset: Column | None = None) -> DataFrame:
    """Each cell as Week, FEC, Dose, DoseText. Blank cells carry nothing and are left out."""
    obs, value = F.col("Observation"), F.col("Value")
    kind = F.substring(obs, 1, 1)
    week = F.regexp_extract(obs, r"^[FT](\d+)", 1).cast("int")
    if offset is not None:
        week = week - offset
    others = [c for c in long.columns if c not in ("Observation", "Value", "WeekOffset")]
    return (long.filter(value.isNotNull() & (value != ""))
            .select(*others, week.cast("int").alias("Week"),
                    F.when(kind == "F", X.parse_number(value)).alias("FEC"),
                    (kind == "T").alias("Dose"),
                    F.when(kind == "T", value).alias("DoseText")))


def fold_count_and_treatment(parsed: DataFrame) -> DataFrame:
    """One row per animal-week: largest count, any treatment, its text."""
    return (parsed.groupBy("AnimalID", "Location", "Year", "Week")
            .agg(F.max("FEC").alias("FEC"), F.bool_or("Dose").alias("Dose"),
                 F.min("DoseText").alias("DoseText"))
            .filter(F.col("FEC").isNotNull() | F.col("Dose")))


def raw_count(fec: DataFrame, locations: DataFrame) -> DataFrame:
    """Count = FEC / Sensitivity of the location in that year."""
    sens = locations.select("Location", "Year", "Sensitivity")
    return (fec.join(sens, ["Location", "Year"], "left")
            .withColumn("Count", F.col("FEC") / F.col("Sensitivity")).drop("Sensitivity"))


def last_dose_weeks(fec: DataFrame, entity: Sequence[str] = ("AnimalID", "Year"),
                    monday: str = "Monday", dose: str = "Dose") -> DataFrame:
    """Weeks since the latest strictly earlier treatment in the same yearly sheet.

    A window holds one animal's year of weekly rows. Never treated gives infinity; the
    count restarts with every sheet.
    """
    day = cal.day_number(F.col(monday))
    w = (W.partitionBy(*entity).orderBy(day.asc())
         .rangeBetween(W.unboundedPreceding, -1))
    last = F.max(F.when(F.col(dose), day)).over(w)
    return fec.withColumn(
        "LastDose", F.coalesce((day - last).cast("double") / 7, F.lit(X.INF)))


def sheet_cells(columns: Sequence[str]) -> Column:
    """The week cells of a sheet row as one array of (Sheet, FEC, Dose, DoseText), blank weeks included.

    ``Sheet`` is the week in the column's name. Several columns of one week are folded: the largest count, any
    treatment, the first of its texts.
    """
    by_week: dict[int, dict[str, list[str]]] = {}
    for c in week_columns(columns):
        by_week.setdefault(int(re.match(r"^[FT](\d+)", c).group(1)), {"F": [], "T": []})[c[0]].append(c)

    def folded(values: list[Column], fold, kind: str) -> Column:
        return fold(*values) if len(values) > 1 else values[0] if values else F.lit(None).cast(kind)
    cells = []
    for week, own in sorted(by_week.items()):
        text = folded([F.when(F.col(c) != "", F.col(c)) for c in own["T"]], F.least, "string")
        count = folded([X.parse_number(F.col(c)) for c in own["F"]], F.greatest, "double")
        cells.append(F.struct(F.lit(week).alias("Sheet"), count.alias("FEC"), text.isNotNull().alias("Dose"), text.alias("DoseText")))
    return F.array(*cells) if cells else F.array().cast("array<struct<Sheet:int,FEC:double,Dose:boolean,DoseText:string>>")


def several_columns_a_week(columns: Sequence[str]) -> bool:
    kinds = [re.match(r"^([FT]\d+)", c).group(1) for c in week_columns(columns)]
    return len(set(kinds)) < len(kinds)


def repeated_animals(sheet: DataFrame) -> bool:
    """Whether an animal has more than one row in a year's sheet; reads its key only."""
    keys = sheet.groupBy(X.make_key(F.col("Farm"), F.col("Name")).alias("AnimalID"), "Year").agg(F.count(F.lit(1)).alias("n"))
    return not keys.filter("n > 1").isEmpty()


def _facts_by_row(keyed: DataFrame, offset: Column) -> DataFrame:
    """Facts of sheet rows that hold an animal's whole year each: folded and scanned inside the row, no shuffle."""
    rows = keyed.select("AnimalID", "Location", "Year", "Sensitivity", offset.alias("Offset"), sheet_cells(keyed.columns).alias("cells"))
    kept = F.filter("cells", lambda c: c["FEC"].isNotNull() | c["Dose"])

    def dated(c: Column, row: Column) -> Column:
        week = c["Sheet"] - row["Offset"]
        return F.struct(week.alias("Week"), c["FEC"].alias("FEC"), (c["FEC"] / row["Sensitivity"]).alias("Count"), c["Dose"].alias("Dose"),
                        c["DoseText"].alias("DoseText"), F.date_add(row["First"], ((week - 1) * 7).cast("int")).alias("Monday"))

    def since(c: Column, dosed: Column) -> Column:
        last = F.array_max(F.filter(dosed, lambda d: d < c["Monday"]))
        return F.coalesce(F.date_diff(c["Monday"], last).cast("double") / 7, F.lit(X.INF))

    # what belongs to the row is bound to a name once; written inside the lambda it would be worked out for every cell
    row = F.struct("Offset", "Sensitivity", cal.first_monday(F.col("Year")).alias("First"))
    cells = F.flatten(F.transform(F.array(row), lambda r: F.transform(kept, lambda c: dated(c, r))))
    rows = rows.select("AnimalID", "Location", "Year", cells.alias("cells"))
    dosed = F.transform(F.filter("cells", lambda c: c["Dose"]), lambda c: c["Monday"])
    facts = F.flatten(F.transform(F.array(dosed), lambda ds: F.transform("cells", lambda c: F.struct(
        *[c[n].alias(n) for n in ("Week", "FEC", "Count", "Dose", "DoseText", "Monday")], since(c, ds).alias("LastDose")))))
    return rows.select("AnimalID", "Location", "Year", F.inline(facts))


def conform_facts(sheet: DataFrame, locations: DataFrame, header: DataFrame | None = None, row_is_animal: bool = False
                  ) -> DataFrame:
    """Weekly facts of every farm-year sheet: count, treatment, raw count, Monday, LastDose.

    With ``row_is_animal``, no animal having more than one row in a year's sheet, the week columns are folded inside
    their row; otherwise they are unpivoted and grouped. Both give the same facts where the promise holds.
    """
    keyed = sheet.withColumns({
        "AnimalID": X.make_key(F.col("Farm"), F.col("Name")),
        "Location": X.make_key(F.col("Farm"), F.col("Location"))})
    known = locations.select("Farm", "Year", "Location", F.lit(True).alias("known"), "Sensitivity")
    keyed = (keyed.drop("Sensitivity").join(known, ["Farm", "Year", "Location"], "left")
             .withColumn("Location", F.when(F.col("known"), F.col("Location"))))
    ids = ["AnimalID", "Location", "Year"]
    offset = None
    if header is not None:
        # a sheet without a row of dates, or with an empty one, stops the load
        dated = keyed.join(week_offset(header).drop("RefDate"), ["Farm", "Year"], "left")
        missing = F.raise_error(F.concat(F.lit("no dates for the sheet of "), "Farm", F.lit(" in "), F.col("Year").cast("string")))
        keyed = dated.withColumn("WeekOffset", F.coalesce("WeekOffset", missing.cast("int")))
        ids, offset = ids + ["WeekOffset"], F.col("WeekOffset")
    if row_is_animal:
        return _facts_by_row(keyed, F.lit(0) if offset is None else offset)
    facts = fold_count_and_treatment(parse_observations(unpivot_weeks(keyed, ids), offset))
    facts = raw_count(facts, locations).withColumn(
        "Monday", cal.monday_of_week(F.col("Year"), F.col("Week")))
    return last_dose_weeks(facts).select(
        "AnimalID", "Location", "Year", "Week", "FEC", "Count", "Dose", "DoseText", "Monday",
        "LastDose")


def dose_text_tally(fec: DataFrame) -> DataFrame:
    return (fec.filter(F.col("DoseText") != "").groupBy("DoseText")
            .agg(F.count(F.lit(1)).alias("n")))


def load_summary(fec: DataFrame) -> DataFrame:
    return fec.groupBy("Year").agg(
        F.min("Week").alias("first_week"), F.min("Monday").alias("first_monday"),
        F.count(F.lit(1)).alias("observations"), F.count_distinct("AnimalID").alias("animals"),
        F.count_distinct("Location").alias("locations"))


def reference_level(df: DataFrame, col: str) -> DataFrame:
    """The most frequent level (ties: first in level order)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("level"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("level")).limit(1))
