"""Hourly readings from landed files: the kept daily table of the stream, and the cache of JSON files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from herdcast.operators import checks as C
from herdcast.operators import weather as wx
from herdcast.sources import readers, sinks
from herdcast.streaming import hourly

KEYS = ["Date", "Temp_high", "Temp_avg", "Temp_low", "Rel_Humidity_avg", "Abs_Humidity_avg"]


def values(df):
    return sorted(tuple(None if v is None else v if i == 0 else round(v, 6) for i, v in enumerate(r)) for r in df.select(*KEYS).collect())


def test_stream_recomputes_only_what_it_touches(spark, tmp_path):
    landing, target, ckpt, daily = (str(tmp_path / n) for n in ("in", "out", "ck", "daily"))

    def land(first, n, day):
        spark.createDataFrame([(i, dt.datetime(2024, 1, day, i % 24), 280.0 + i % 9, 275.0) for i in range(first, first + n)],
                              hourly.READING).coalesce(1).write.mode("append").parquet(landing)

    def run(**more):
        return hourly.ingest(hourly.read_readings(spark, landing), target, ckpt, daily=daily, **more)
    for day in range(1, 11):
        land(100 * day, 24, day)
    assert sum(r.rows_read for r in run()) == 240
    land(520, 10, 5)            # four readings again and six new ones
    done = run()
    assert [(r.dates, r.rows_read) for r in done] == [((dt.date(2024, 1, 5),), 34)]     # 24 landed before, 10 now
    plan = hourly.landed_on(spark, target, (dt.date(2024, 1, 5),))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(reading_date" in plan.replace("isnotnull(reading_date#", "(reading_date#")      # other folders are not opened
    assert run() == []
    assert values(hourly.read_maintained(spark, daily)) == values(hourly.read_daily(spark, target))
    assert hourly.read_maintained(spark, daily).count() == 10
    # a batch that runs again replaces its own output
    hourly.ingest(hourly.read_readings(spark, landing), target, str(tmp_path / "ck2"), daily=daily)
    assert values(hourly.read_maintained(spark, daily)) == values(hourly.read_daily(spark, target))


def test_stream_state_drops_repeats(spark, tmp_path):
    landing, target, ckpt, daily = (str(tmp_path / n) for n in ("in", "out", "ck", "daily"))
    rows = [(i % 12, dt.datetime(2024, 1, 5, i % 12), 280.0 + i % 12, 275.0) for i in range(24)] + [(99, None, 280.0, 275.0)]
    spark.createDataFrame(rows[:12] + rows[24:], hourly.READING).coalesce(1).write.parquet(landing)
    hourly.ingest(hourly.read_readings(spark, landing), target, ckpt, daily=daily, within="2 days")
    spark.createDataFrame(rows[12:24], hourly.READING).coalesce(1).write.mode("append").parquet(landing)
    hourly.ingest(hourly.read_readings(spark, landing), target, ckpt, daily=daily, within="2 days")
    assert spark.read.parquet(target).where("reading_id < 99").count() == 12
    kept = {r.Date: r.Temp_high for r in hourly.read_maintained(spark, daily).collect()}
    assert kept[dt.date(2024, 1, 5)] == pytest.approx(291.0 - 273.15)


def write_day(folder, day, temps, text=None):
    folder = folder / str(day.year)
    folder.mkdir(parents=True, exist_ok=True)
    said = json.dumps({"lat": 1, "hourly": [{"temp": t + 273.15, "humidity": 50, "dew_point": t + 270.15, "rain": 0.1} for t in temps]})
    (folder / f"{day}.json").write_text(said if text is None else text)


def test_files_to_cache_and_season(spark, tmp_path):
    landed, cache = tmp_path / "landed", str(tmp_path / "cache")
    first = dt.date(2000, 3, 1)
    for k in range(500):
        if k != 40:
            write_day(landed, first + dt.timedelta(k), [k % 20, k % 20 + 2.0], "{ broken" if k == 45 else None)
    read = readers.read_hourly(spark, f"{landed}/2*")
    assert read.count() == 499 and read.where("broken IS NOT NULL").select("date").first()[0] == first + dt.timedelta(45)
    got = sinks.update_weather_cache(spark, f"{landed}/2*", cache)
    by_day = {r.Date: r for r in got.collect()}
    assert len(by_day) == 500
    assert by_day[first + dt.timedelta(40)].Temp_avg is None and by_day[first + dt.timedelta(45)].Temp_avg is None
    assert by_day[first].Temp_avg == 1.0 and by_day[first].Temp_high == 2.0
    # known days are not read again, whatever their files say now; new ones are, and years without change stay
    write_day(landed, first, [99.0])
    write_day(landed, first + dt.timedelta(505), [5.0])
    before = {f for f in spark.read.parquet(cache).inputFiles() if "Year=2000" in f}
    again = {r.Date: r for r in sinks.update_weather_cache(spark, f"{landed}/2*", cache).collect()}
    assert len(again) == 506 and again[first].Temp_avg == 1.0 and again[first + dt.timedelta(505)].Temp_avg == 5.0
    assert before == {f for f in spark.read.parquet(cache).inputFiles() if "Year=2000" in f}
    with pytest.raises(C.CheckFailed):
        sinks.extract_weather(spark, f"{landed}/2*", cache, 2001, "2002-01-01")          # ends too early
    season = sinks.extract_weather(spark, f"{landed}/2*", cache, 2001, "2001-07-20", impute="linear")
    assert season.where("Temp_avg IS NULL").isEmpty() and C.contiguous_dates(season).isEmpty()
    assert season.agg(F.min("Week")).first()[0] == -36
    (landed / "2001" / "nodate.json").write_text("{}")
    with pytest.raises(C.CheckFailed):
        sinks.update_weather_cache(spark, f"{landed}/2*", cache)


def test_rollup_keeps_unreadable_days(spark):
    files = spark.createDataFrame([(dt.date(2024, 1, 1), None)], "date date, hourly array<struct<temp:double,humidity:double,dew_point:double>>")
    assert values(wx.hourly_weather_rollup(files)) == [(dt.date(2024, 1, 1), None, None, None, None, None)]
