"""Incremental ingest of hourly readings from a landing folder.

Each micro-batch reads only files it has not seen (the checkpoint replaces a cache of
finished dates) and lands its readings once, in folders by date. A daily table is kept up to date beside
them: a batch recomputes the dates it touches from their landed readings, old and new, and replaces just
those. Readings are de-duplicated on the reading key within a date, so a file that arrives late for a day already seen is
counted in full and no watermark can drop it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdcast.functions import expr as X
from herdcast.operators.weather import KELVIN

READING = T.StructType([
    T.StructField("reading_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("temp", T.DoubleType()), T.StructField("dew_point", T.DoubleType())])


def read_readings(spark: SparkSession, folder: str, schema: T.StructType = READING,
                  max_files: int | None = None) -> DataFrame:
    """File stream over a landing folder of Parquet readings."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


DAY = "reading_date"           # folder of the landed readings
_DYNAMIC = {"partitionOverwriteMode": "dynamic"}


@dataclass(frozen=True)
class Refreshed:
    """What a micro-batch did: the dates it touched and how many landed readings it read to recompute them."""
    batch: int
    dates: tuple
    rows_read: int


def _on(day: Column, dates: Sequence) -> Column:
    known = [d for d in dates if d is not None]
    return day.isin(known) | (day.isNull() if len(known) < len(dates) else F.lit(False))


def ingest(readings: DataFrame, target: str, checkpoint: str, key: Sequence[str] = ("reading_id",), daily: str | None = None,
           within: str | None = None) -> list[Refreshed]:
    """Land everything new, bring the table in ``daily`` (if any) up to date, then stop.

    A micro-batch replaces its own ``reading_date=.../batch=<id>`` folders and whole days of the daily table, so one
    that runs again after a failure replaces its output instead of adding to it. ``within`` (such as "1 hour") also drops
    readings seen before already in the stream's state, for that long; it lands fewer repeated rows and changes no daily value.
    Readings without a timestamp are landed and belong to a day without date.
    """
    done: list[Refreshed] = []
    if within is not None:
        readings = readings.withWatermark("ts", within).dropDuplicatesWithinWatermark(list(key))

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates(list(key)).withColumns({DAY: F.to_date("ts"), "batch": F.lit(batch_id)})
        rows.write.options(**_DYNAMIC).mode("overwrite").partitionBy(DAY, "batch").parquet(target)
        if daily is None:
            return
        landed = spark.read.parquet(target)
        dates = tuple(r[0] for r in landed.where(F.col("batch") == batch_id).select(DAY).distinct().collect())
        if not dates:
            return
        counted = Observation()
        own = landed_on(spark, target, dates).observe(counted, F.count(F.lit(1)).alias("n"))
        (daily_from_readings(own.drop("batch"), key).withColumn("Day", F.col("Date"))
         .write.options(**_DYNAMIC).mode("overwrite").partitionBy("Day").parquet(daily))
        done.append(Refreshed(batch_id, dates, counted.get["n"]))

    (readings.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return done


def landed_on(spark: SparkSession, target: str, dates: Sequence) -> DataFrame:
    """Landed readings of some dates; only their folders are read."""
    return spark.read.parquet(target).where(_on(F.col(DAY), dates)).drop(DAY)


def read_maintained(spark: SparkSession, daily: str) -> DataFrame:
    """The daily table that ``ingest`` keeps."""
    return spark.read.parquet(daily).drop("Day")


def daily_from_readings(readings: DataFrame, key: Sequence[str] = ("reading_id",)) -> DataFrame:
    temp, dew = F.col("temp") - KELVIN, F.col("dew_point") - KELVIN
    rh = X.rel_humidity(temp, dew)
    return (readings.dropDuplicates(list(key))
            .select(F.to_date("ts").alias("Date"), temp.alias("t"), rh.alias("rh"),
                    X.abs_humidity(temp, rh).alias("ah"))
            .groupBy("Date")
            .agg(F.max("t").alias("Temp_high"), F.avg("t").alias("Temp_avg"),
                 F.min("t").alias("Temp_low"), F.avg("rh").alias("Rel_Humidity_avg"),
                 F.avg("ah").alias("Abs_Humidity_avg")))


def read_daily(spark: SparkSession, target: str, key: Sequence[str] = ("reading_id",)
               ) -> DataFrame:
    return daily_from_readings(spark.read.parquet(target), key)
