"""Archive round trip and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from herdcast import fixtures as fx
from herdcast.queries.base import abs_hum, query, rel_hum, round_doubles, s6, scratch
from herdcast.sources import archive, sinks
from herdcast.streaming import hourly


def _tables(spark, d):
    return {"Locations": fx.locations(spark, d), "Animal": fx.animal(spark, d),
            "FEC": fx.fec(spark, d), "Weather": fx.weather(spark, d)}


def _tally(tables):
    out = None
    for name, df in tables.items():
        part = df.groupBy("Year").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("name"), "Year", "n")
        out = part if out is None else out.unionByName(part)
    return out


def _tally_sql(where: str = "TRUE", weather: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS name, Year, count(*) AS n FROM {v} "
        f"WHERE {weather if n == 'Weather' else where} GROUP BY 2"
        for n, v in (("Locations", "locations"), ("Animal", "animal"), ("FEC", "counts"),
                     ("Weather", "weather")))


_VIEWS = ["locations", "animal", "counts", "weather"]


@query("save_archive", _tally_sql(), _VIEWS)
def save_archive(spark, d):
    path = scratch(spark, "archive")
    archive.save_archive(_tables(spark, d), path)
    return _tally(archive.load_archive(spark, path, validate=False))


@query("load_archive", _tally_sql("Year IN (1997, 1998)", "Year IN (1996, 1997, 1998)"), _VIEWS)
def load_archive(spark, d):
    path = scratch(spark, "archive")
    archive.save_archive(_tables(spark, d), path)
    return _tally(archive.load_archive(spark, path, years=(1997, 1998), validate=False))


@query("hourly_weather_stream", f"""
SELECT D AS Date, {s6('max(t)')} AS Temp_high, {s6('avg(t)')} AS Temp_avg, {s6('min(t)')} AS Temp_low,
  {s6('avg(rh)')} AS Rel_Humidity_avg, {s6('avg(ah)')} AS Abs_Humidity_avg
FROM (SELECT D, t, rh, {abs_hum('t', 'rh')} AS ah FROM (
  SELECT D, t, {rel_hum('t', '(t - 3)')} AS rh FROM (
    SELECT CAST(ts AS DATE) AS D, value % 40 - 10 AS t FROM events WHERE value IS NOT NULL)))
GROUP BY D""")
def hourly_weather_stream(spark, d):
    schema = fx.table(spark, d, "events").select("event_id", "ts", "value").schema
    stream = hourly.read_readings(spark, f"{d}/events.parque[t]", schema)
    temp = F.col("value") % 40 - 10 + 273.15
    readings = stream.filter("value IS NOT NULL").select(
        F.col("event_id").alias("reading_id"), "ts", temp.alias("temp"),
        (temp - 3).alias("dew_point"))
    root = scratch(spark, "hourly")
    hourly.ingest(readings, f"{root}/readings", f"{root}/checkpoint", daily=f"{root}/daily")
    return round_doubles(hourly.read_maintained(spark, f"{root}/daily"))


def _half_even(z: str) -> str:
    """To whole numbers, halves (but for floating noise) to the even one."""
    return (f"CASE WHEN abs({z} - floor({z}) - 0.5) < 1e-6 THEN floor({z}) + (CAST(floor({z}) AS BIGINT) & 1) "
            f"ELSE round({z}) END")


_BY_DAY = f"""
SELECT D AS Date, max(t) AS Temp_high, avg(t) AS Temp_avg, min(t) AS Temp_low, avg(rh) AS Rel_Humidity_avg, avg(ah) AS Abs_Humidity_avg
FROM (SELECT D, t, rh, {abs_hum('t', 'rh')} AS ah
      FROM (SELECT D, t, {rel_hum('t', 'dp')} AS rh, dp
            FROM (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS D, avg(l_quantity) / 2 + 265 - 273.15 AS t,
                    avg(l_quantity) / 2 + 265 - l_linenumber - 273.15 AS dp
                  FROM lineitem GROUP BY date_trunc('week', l_shipdate), l_linenumber)))
WHERE day(D) <> 13 GROUP BY D"""
_MEASURES = ("Temp_high", "Temp_avg", "Temp_low", "Rel_Humidity_avg", "Abs_Humidity_avg")


@query("weather_from_files", f"""
SELECT c.Date, {', '.join(f"{_half_even(f'round(w.{m}, 9) * 100')} / 100 + 0 AS {m}" for m in _MEASURES)}
FROM (SELECT CAST(unnest(generate_series(date_trunc('week', min(l_shipdate)), date_trunc('week', max(l_shipdate)), INTERVAL 1 DAY)) AS DATE) AS Date FROM lineitem) c
LEFT JOIN ({_BY_DAY}) w ON c.Date = w.Date""")
def weather_from_files(spark, d):
    """A file lands for each week's Monday, those of a 13th broken; the first year goes through the cache before the others land."""
    root = scratch(spark, "files")
    days = fx.hourly_readings(spark, d, "week").withColumn("text", F.when(F.dayofmonth("date") == 13, F.lit("{ broken")).otherwise(
        F.to_json(F.struct("hourly")))).select("date", "text")
    first = F.year("date") == days.agg(F.year(F.min("date"))).scalar()
    for part in (first, ~first):
        days.where(part).repartition("date").write.mode("append").partitionBy("date").text(f"{root}/landed")
        sinks.update_weather_cache(spark, f"{root}/landed/*", f"{root}/cache")
    return spark.read.parquet(f"{root}/cache").select("Date", *_MEASURES)
