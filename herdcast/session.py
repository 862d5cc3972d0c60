"""Session set-up and the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "herdcast", **conf: str) -> SparkSession:
    """A session with the settings the engine relies on; cluster settings win where set."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (a test) gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="herdcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", shared)
    spark.sparkContext.setCheckpointDir(shared)
    return shared


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several passes follow: later plans start from a pruned columnar scan instead
    of the whole lineage, and the loss of an executor costs no recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/herdcast/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Drops the shuffle files of plans nothing refers to any more; else they stay until the driver's heap fills."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()
