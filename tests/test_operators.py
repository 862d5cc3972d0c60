import datetime as dt

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from simulate import herd, monday

from herdcast.operators import checks as C
from herdcast.operators import conform as cf
from herdcast.operators import features as ft
from herdcast.operators import group_model as gm
from herdcast.operators import joins as J
from herdcast.operators import lags as L
from herdcast.operators import weather as wx
from herdcast.operators import windows as B
from herdcast.sources import archive, readers, sinks
from herdcast.streaming import hourly


@pytest.fixture(scope="module")
def tables(spark):
    loc, ani, fec, wxs = (df.persist() for df in herd(spark))
    return {"Locations": loc, "Animal": ani, "FEC": fec, "Weather": wxs}


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_blocks_equal_one_window_for_a_hot_long_series(spark):
    """A series holding most rows, cut into short blocks, equals the uncut window."""
    df = spark.range(4000).select(F.when(F.col("id") % 5 == 0, F.col("id") % 7).otherwise(99).alias("k"),
                                  F.col("id").alias("pos"), (F.col("id") * 37 % 101).alias("v"))
    frame = (-30, -3)
    plain = df.withColumn("s", F.sum("v").over(W.partitionBy("k").orderBy("pos").rangeBetween(*frame)))
    cut = B.with_blocks(df, F.col("pos"), 30, 64)
    cut = B.core_rows(cut.withColumn(
        "s", F.sum("v").over(W.partitionBy("k", B.BLOCK).orderBy("pos").rangeBetween(*frame))))
    assert rows(plain, "k", "pos", "s") == rows(cut, "k", "pos", "s")
    longest = B.with_blocks(df, F.col("pos"), 30, 64).groupBy("k", B.BLOCK).count().agg(F.max("count"))
    assert longest.first()[0] <= 94
    with pytest.raises(ValueError):
        B.with_blocks(df, F.col("pos"), 65, 64)


def test_range_lags_equal_dense_grid_row_lags(spark, tables):
    facts = tables["FEC"].select("AnimalID", "Monday", "FEC", "Dose")
    got = L.history_lags(facts).select("AnimalID", "Monday", "fec4wk", "fec12wk", "dose5_12wk")
    dense = J.dense_weeks(facts, ("AnimalID",), "Monday")
    w = W.partitionBy("AnimalID").orderBy("Monday")
    want = (dense.withColumns({
        "fec4wk": F.avg(F.log1p("FEC")).over(w.rowsBetween(-5, -3)),
        "fec12wk": F.avg(F.log1p("FEC")).over(w.rowsBetween(-13, -11)),
        "dose5_12wk": F.coalesce(F.bool_or("Dose").over(w.rowsBetween(-12, -5)), F.lit(False))})
        .filter("FEC IS NOT NULL"))
    cols = ("AnimalID", "Monday", "fec4wk", "fec12wk", "dose5_12wk")
    assert rows(got, *cols) == rows(want, *cols)


def test_rolling_weather_needs_all_28_days(spark, tables):
    full = tables["Weather"]
    gap = full.filter("Date <> '2001-03-14'")
    a = {r.Monday: r for r in wx.rolling_weather(full, lags=(0,), block_days=100).collect()}
    b = {r.Monday: r for r in wx.rolling_weather(gap, lags=(0,)).collect()}
    days = {r.Date: r.Temp_low for r in full.collect()}
    hole = dt.date(2001, 3, 14)
    for m, r in a.items():
        window = [days.get(m - dt.timedelta(k)) for k in range(1, 29)]
        if None in window:
            assert r.Temp_low_0 is None
        else:
            assert r.Temp_low_0 == min(window)
            assert r.Temp_frost_0 == sum(v < 0 for v in window)
            touched = 1 <= (m - hole).days <= 28
            assert (b[m].Temp_low_0 is None) == touched


def test_imputation_keeps_observed_and_fills_gaps(spark, tables):
    daily = tables["Weather"].filter("day(Date) NOT IN (7, 8, 9)").select("Date", "Temp_avg")
    filled = wx.calendar_fill(daily)
    for how in (wx.impute_gaps, wx.impute_linear):
        out = {r.Date: r.Temp_avg for r in how(filled, measures=("Temp_avg",)).collect()}
        seen = {r.Date: r.Temp_avg for r in daily.collect()}
        assert all(out[k] == v for k, v in seen.items())
        assert None not in out.values() and len(out) == filled.count()
        lo, hi = min(seen.values()), max(seen.values())
        assert all(lo <= v <= hi for v in out.values())


def test_headers():
    assert cf.normalise_headers(["Name", " Av FEC 2001", None, "T 12", ""]) == \
        ["Name", "AvFEC", "blank1", "T12", "blank2"]
    with pytest.raises(ValueError):
        cf.normalise_headers(["Name"])
    assert C.required_columns(["a", "b", "a"], ["a", "c"]) == ["duplicate column a", "missing column c"]
    assert C.required_columns(["b", "a"], ["a", "b"], in_order=True)


def sheet(spark, **change):
    base = {"Farm": "North", "Year": 2001, "Name": "Bo", "Tag": "1", "Sex": "dkg", "Age": "<1",
            "Location": "Field 0", "ClinicalRisk": None, "AvFEC": "", "Notes": "n",
            "F12": "150", "T12": None, "F13": None, "T13": "MOX", "F14": "x", "T14": ""}
    rows = [base | change, base | {"Name": "Al", "Tag": "2", "F13": "50"}]
    return spark.createDataFrame([tuple(r.values()) for r in rows],
                                 ", ".join(f"{k} {'int' if k == 'Year' else 'string'}" for k in base))


def test_sheet_to_facts(spark, tables):
    header = spark.createDataFrame([("North", 2001, None, "36976")], "Farm string, Year int, F12 string, F13 string")
    offset = cf.week_offset(header).first()
    assert (offset.RefDate, offset.WeekOffset) == (dt.date(2001, 3, 26), 0)
    animals, facts = readers.load_dosing_sheets(sheet(spark), tables["Locations"], header)
    assert rows(animals, "AnimalID", "Location", "Sex", "Age", "ClinicalRisk") == [
        ("North_Al", "North_Field0", "DKM", 0.0, "Normal"),
        ("North_Bo", "North_Field0", "DKM", 0.0, "Normal")]
    got = rows(facts, "AnimalID", "Week", "FEC", "Count", "Dose", "DoseText", "Monday")
    assert ("North_Al", 13, 50.0, 1.0, True, "MOX", monday(2001, 13)) in got
    assert ("North_Bo", 13, None, None, True, "MOX", monday(2001, 13)) in got
    assert len(got) == 4


@pytest.mark.parametrize("change, text", [
    ({"Sex": "??"}, "Sex"), ({"Age": "old"}, "Age"), ({"AvFEC": "many"}, "AvFEC"),
    ({"ClinicalRisk": "severe"}, "ClinicalRisk"), ({"F13": "MOX"}, "count column"),
    ({"Name": "Al", "Tag": "2"}, "duplicated"), ({"Location": None}, "blank")])
def test_bad_sheets_are_refused(spark, tables, change, text):
    with pytest.raises(C.CheckFailed, match=text):
        readers.load_dosing_sheets(sheet(spark, **change), tables["Locations"])


def test_rows_in_unknown_fields_stay_without_location(spark, tables):
    """One animal of two is in a field nobody declared: it is noted and kept; only if all are, the load stops."""
    with pytest.warns(UserWarning, match="1 rows of 1 fields"):
        animals, facts = readers.load_dosing_sheets(sheet(spark).where("Name = 'Al'").unionByName(
            sheet(spark, Location="Back Field").where("Name <> 'Al'")), tables["Locations"])
    assert {(r.AnimalID, r.Location, r.Field) for r in animals.collect()} == {("North_Al", "North_Field0", "Field 0"), ("North_Bo", None, "Back Field")}
    assert {r.Location for r in facts.where("AnimalID = 'North_Bo'").collect()} == {None}
    with pytest.raises(C.CheckFailed, match="every row"):
        readers.load_dosing_sheets(sheet(spark).withColumn("Location", F.lit("Back Field")), tables["Locations"])


def test_facts_inside_their_rows(spark, tables):
    """Folding inside a row gives what grouping gives: dates shifted by a header, several columns of a week, unknown fields,
    weeks before the year, texts that are no numbers. No shuffle between the sheet and its facts."""
    header = spark.createDataFrame([("North", 2001, None, "36983")], "Farm string, Year int, F12 string, F13 string")
    wide = sheet(spark, F14="70").withColumns({"F13b": F.lit("90"), "T12b": F.lit("IVM"), "T30": F.when(F.col("Name") == "Al", "FBZ"),
                                              "F31": F.lit(" 12 "), "F0": F.lit("5"), "T0": F.lit(" ")})
    wide = wide.unionByName(wide.withColumns({"Name": F.concat("Name", F.lit("2")), "Location": F.lit("Back Field")}))
    for dates in (header, None):
        plain = cf.conform_facts(wide, tables["Locations"], dates)
        inside = cf.conform_facts(wide, tables["Locations"], dates, row_is_animal=True)
        assert inside.columns == plain.columns and inside.schema.simpleString() == plain.schema.simpleString()
        assert sorted(map(str, inside.collect())) == sorted(map(str, plain.collect()))
        assert inside.count() == 20                     # five weeks each: Al has no count in week 14, but a treatment in week 30
    plan = cf.conform_facts(wide, F.broadcast(tables["Locations"]), row_is_animal=True)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    assert cf.repeated_animals(wide.unionByName(wide)) and not cf.repeated_animals(wide)
    assert cf.several_columns_a_week(wide.columns) and not cf.several_columns_a_week(["F1", "T1", "F2", "Name"])


def test_an_animal_with_two_rows_is_grouped(spark, tables):
    """One name with two tags: both rows' cells are one animal's year, and two counts of a week are refused."""
    two = sheet(spark, F13=None).where("Name = 'Bo'")
    other = two.withColumns({"Tag": F.lit("9"), "F12": F.lit(None).cast("string"), "T13": F.lit(None).cast("string"), "F14": F.lit("8")})
    _, facts = readers.load_dosing_sheets(two.unionByName(other), tables["Locations"], validate=False)
    assert rows(facts, "AnimalID", "Week", "FEC", "LastDose") == [
        ("North_Bo", 12, 150.0, float("inf")), ("North_Bo", 13, None, float("inf")), ("North_Bo", 14, 8.0, 1.0)]
    with pytest.raises(C.CheckFailed, match="more than one observation"):
        readers.load_dosing_sheets(two.unionByName(other.withColumn("F12", F.lit("1"))), tables["Locations"])


def test_locations_and_weather_loads(spark, tables):
    raw = spark.createDataFrame([("A", "North Field", "None", "50")], "Farm string, Location string, Hygiene string, Sensitivity string")
    loc = readers.conform_locations(raw, 2001)
    assert loc.first().Location == "A_NorthField"
    with pytest.raises(C.CheckFailed, match="duplicated"):
        readers.append_checked(loc, loc, ("Farm", "Location", "Year"), "location")
    with pytest.raises(C.CheckFailed, match="Hygiene"):
        readers.conform_locations(raw.withColumn("Hygiene", F.lit("Daily")), 2001)
    daily = C.last_weeks(tables["Weather"])
    stored = readers.load_weather(daily)
    assert rows(stored, "Date") == rows(tables["Weather"], "Date")
    part = daily.filter("Year = 2001").withColumn("Temp_avg", F.lit(1.0))
    merged = readers.load_weather(part, stored)
    assert merged.filter("Temp_avg = 1.0").count() == 365 and merged.count() == stored.count()
    with pytest.raises(C.CheckFailed, match="duplicated"):
        readers.load_weather(part, stored, replace=False)
    with pytest.raises(C.CheckFailed, match="missing date"):
        readers.load_weather(daily.filter("Date <> '2001-06-06'"))


def test_archive_round_trip(spark, tables, tmp_path):
    path = str(tmp_path / "archive")
    archive.save_archive(tables, path)
    back = archive.load_archive(spark, path)
    for name, df in tables.items():
        assert rows(df, *sorted(df.columns)) == rows(back[name], *sorted(df.columns))
    frame = ft.group_rows(tables["FEC"], tables["Animal"], tables["Locations"])
    again = ft.group_rows(back["FEC"], back["Animal"], back["Locations"])
    assert rows(frame.drop("meanLogFEC"), "*") == rows(again.drop("meanLogFEC"), "*")
    with pytest.raises(Exception, match="already exists"):
        archive.save_archive(tables, path)
    with pytest.raises(C.CheckFailed, match="duplicated"):
        archive.load_archive(spark, path, stored=back)
    archive.save_archive(tables, path, overwrite=True)
    part = archive.load_archive(spark, path, years=(2002,))
    assert rows(part["FEC"].select("Year").distinct(), "Year") == [(2002,)]
    assert rows(part["Weather"].select("Year").distinct(), "Year") == [(2001,), (2002,)]
    with pytest.raises(C.CheckFailed, match="not present"):
        archive.load_archive(spark, path, years=(1990,))


def test_a_save_that_dies_leaves_the_old_archive(spark, tables, tmp_path):
    """The third table fails while it is written: the first version is still what is read, and the next save goes on from it."""
    path = str(tmp_path / "archive")
    archive.save_archive(tables, path)
    new = {n: df.withColumn("Sensitivity", F.lit(7.0)) if n == "Locations" else df for n, df in tables.items()}
    third = list(new)[2]
    bad = new[third].withColumn("Year", F.when(F.rand() < 2, F.raise_error(F.lit("lost"))).cast("int"))
    with pytest.raises(Exception, match="lost"):
        archive.save_archive(new | {third: bad}, path, overwrite=True)
    kept = archive.load_archive(spark, path)
    assert rows(kept["Locations"], "Location", "Sensitivity") == rows(tables["Locations"], "Location", "Sensitivity")
    assert kept[third].count() == tables[third].count()
    archive.save_archive(new, path, overwrite=True)
    assert archive.snapshot(spark, path)[0] == 2
    assert {r[0] for r in archive.load_archive(spark, path)["Locations"].select("Sensitivity").collect()} == {7.0}
    with pytest.raises(FileNotFoundError):
        archive.load_archive(spark, str(tmp_path / "nothing"))


def test_an_archive_without_manifest_is_read(spark, tables, tmp_path):
    """Tables side by side in a folder, as archives were before snapshots, are version 0 and replaced only when asked."""
    path = str(tmp_path / "archive")
    for name, df in tables.items():
        df.write.partitionBy("Year").parquet(f"{path}/{name}")
    assert archive.load_archive(spark, path)["FEC"].count() == tables["FEC"].count()
    with pytest.raises(FileExistsError):
        archive.save_archive(tables, path)
    archive.save_archive(tables, path, overwrite=True)
    assert archive.snapshot(spark, path)[0] == 1


def test_frames_hold_their_invariants(spark, tables):
    group = ft.group_rows(tables["FEC"], tables["Animal"], tables["Locations"])
    assert C.group_invariants(group).isEmpty()
    ind = ft.individual_rows(tables["FEC"], tables["Animal"], tables["Locations"])
    assert ind.filter("LastDoseCat IS NULL").isEmpty() and ind.filter("Farm IS NULL").isEmpty()
    assert ind.count() == ft.filter_season(tables["FEC"]).count()


def test_stream_reads_new_files_once_and_counts_late_ones(spark, tmp_path):
    landing, target, ckpt = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def land(first, n, day):
        ids = range(first, first + n)
        spark.createDataFrame([(i, dt.datetime(2024, 1, day, i % 24), 280.0 + i % 9, 275.0) for i in ids],
                              hourly.READING).coalesce(1).write.mode("append").parquet(landing)
    land(0, 24, 5)
    hourly.ingest(hourly.read_readings(spark, landing), target, ckpt)
    once = hourly.read_daily(spark, target)
    assert rows(once, "Date") == [(dt.date(2024, 1, 5),)]
    land(20, 4, 5)      # readings already seen, delivered again
    land(30, 6, 1)      # a day long before anything read so far
    hourly.ingest(hourly.read_readings(spark, landing), target, ckpt)
    hourly.ingest(hourly.read_readings(spark, landing), target, ckpt)
    assert spark.read.parquet(target).count() == 34
    twice = hourly.read_daily(spark, target)
    assert rows(twice, "Date") == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 5),)]
    a = once.first()
    b = twice.filter("Date = '2024-01-05'").first()
    assert b.Temp_avg == pytest.approx(a.Temp_avg) and b.Temp_high == a.Temp_high


def test_written_tables(spark, tables, tmp_path):
    codes = sinks.code_table(spark).collect()
    assert codes[0].Sex == "" and len(codes) == 20
    assert [r.SexCategory for r in codes] == sorted(r.SexCategory for r in codes)
    nxt = sinks.next_season_sheets(sheet(spark)).collect()
    assert {(r.Name, r.Age, r.AvFEC, r.Year, r.ClinicalRisk, r.OldNotes, r.Notes) for r in nxt} == {
        ("Bo", 1.0, 150.0, 2002, "Normal", "n", ""), ("Al", 1.0, 100.0, 2002, "Normal", "n", "")}
    half = sinks.next_season_sheets(sheet(spark, F12="100", F13="125")).filter("Name = 'Bo'").first()
    assert half.AvFEC == 112.0          # 112.5 rounds to even
    assert sinks.next_season_sheets(sheet(spark, Location="DEAD")).count() == 1


def test_coefficients_are_read_back(spark, tmp_path):
    """Sections, left-out terms and order survive; a formula with other names, and a name given twice, are refused."""
    path = str(tmp_path / "list")
    cols = "ord int, groupcoefnames string, groupcoefs double"
    lines = [("Group Coefficients:", None), ("", None), ("(Intercept)", 1.5), ("FarmB", None), ("x", -2e-7), ("", None), ("Constants:", None), ("", None), ("sd", 0.7)]
    sinks.write_coefficients(spark.createDataFrame([(i, *r) for i, r in enumerate(lines)], cols), path)
    back = readers.read_coefficients(spark, path)
    assert back == {"Group Coefficients:": {"(Intercept)": 1.5, "FarmB": None, "x": -2e-7}, "Constants:": {"sd": 0.7}}
    group = spark.createDataFrame([("A", 2001, 3.0, 9), ("B", 2001, 4.0, 9), ("C", 2001, 4.0, 9), ("A", 2002, None, 9)],
                                  "Farm string, Year int, x double, TotalAnimals int")
    given = back["Group Coefficients:"]
    fit = gm.stored_group_fit(group, given | {"x": 2.0}, {"Farm": ["A", "B"]}, ("factor(Farm)", "x"))
    for predict in (gm.predict_single, gm.predict_excluded):
        assert rows(predict(group, fit, "p"), "Farm", "Year", "p") == [
            ("A", 2001, 7.5), ("A", 2002, None), ("B", 2001, 9.5), ("C", 2001, None)]
    with pytest.raises(ValueError, match="differ in FarmB"):
        gm.stored_group_fit(group, given, {"Farm": ["A"]}, ("factor(Farm)", "x"))
    sinks.write_coefficients(spark.createDataFrame([(0, "S:", None), (1, "a", 1.0), (2, "a", 2.0)], cols), path)
    with pytest.raises(C.CheckFailed, match="twice"):
        readers.read_coefficients(spark, path)
