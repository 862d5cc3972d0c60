"""Parquet archive of the four tables, partitioned by year.

A save writes a snapshot into a folder of its own and then, as its last step, appends one line to the manifest.
Readers take the snapshot of the highest version there, so that a save that dies half-way leaves the archive as it was.
One writer at a time; snapshots of earlier versions stay for the owner of the folder to clear.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdcast.operators import checks as C
from herdcast.schema import KEYS, TABLES


def select_years(tables: dict[str, DataFrame], years: Sequence[int] | None) -> dict[str, DataFrame]:
    """Rows of the wanted years; weather also keeps the year before each (it looks back)."""
    if years is None:
        return dict(tables)
    wider = sorted({*years, *[y - 1 for y in years]})
    return {n: df.filter(F.col("Year").isin(*(wider if n == "Weather" else years)))
            for n, df in tables.items()}


def _require_years(tables: dict[str, DataFrame], names: Sequence[str], years: Sequence[int]) -> None:
    for name in names:
        have = {r[0] for r in tables[name].select("Year").distinct().collect()}
        missing = sorted(set(years) - have)
        if missing:
            raise C.CheckFailed(f"year {missing[0]} not present in {name}")


def _there(spark: SparkSession, path: str, schema: str, form: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def snapshot(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(version, folder) of the archive's current snapshot; version 0 without manifest; None where nothing was saved."""
    saved = _there(spark, f"{path}/manifest", "version int, folder string", "json")
    last = saved.agg(F.max(F.struct("version", "folder")).alias("m")).first()["m"] if saved is not None else None
    if last is not None:
        return last["version"], last["folder"]
    return None if _there(spark, f"{path}/FEC", "Year int", "parquet") is None else (0, ".")


def save_archive(tables: dict[str, DataFrame], path: str, years: Sequence[int] | None = None,
                 overwrite: bool = False, compression: str = "zstd") -> None:
    """Write the four tables as one snapshot; an existing archive is only replaced when asked.

    Rows are rebalanced by year before the write: a year is a few files of the advisory
    partition size, and a year larger than that is split over more tasks.
    """
    if years is not None:
        _require_years(tables, ("FEC", "Weather"), years)
    chosen = select_years(tables, years)
    spark = next(iter(chosen.values())).sparkSession
    before = snapshot(spark, path)
    if before is not None and not overwrite:
        raise FileExistsError(f"the archive {path} already exists")
    version = before[0] + 1 if before else 1
    folder = f"snapshot-{version:06d}-{uuid.uuid4().hex}"
    for name, df in chosen.items():
        (df.select(*TABLES[name].fieldNames())
         .hint("rebalance", F.col("Year"))
         .write.option("compression", compression).partitionBy("Year").parquet(f"{path}/{folder}/{name}"))
    spark.createDataFrame([(version, folder)], "version int, folder string").coalesce(1).write.mode("append").json(f"{path}/manifest")


def load_archive(spark: SparkSession, path: str, years: Sequence[int] | None = None,
                 stored: dict[str, DataFrame] | None = None, validate: bool = True
                 ) -> dict[str, DataFrame]:
    """Read the archive (partition-pruned by year), append to stored tables, check keys."""
    current = snapshot(spark, path)
    if current is None:
        raise FileNotFoundError(f"there is no archive at {path}")
    read = {n: spark.read.schema(s).parquet(f"{path}/{current[1]}/{n}").select(*s.fieldNames())
            for n, s in TABLES.items()}
    if years is not None and validate:
        _require_years(read, ("Locations", "Animal", "FEC", "Weather"), years)
    out = {}
    for name, df in select_years(read, years).items():
        both = df if stored is None else stored[name].unionByName(df)
        if validate:
            C.require(C.unique_key(both, KEYS[name]), f"duplicated {name} key")
        out[name] = both
    return out
