"""Session defaults and the shared scratch location."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lets AQE split a hot join key even where the plan above needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "obslake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; `conf` keys use '__' for '.'."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir, or else below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the checkpoint folder the session was given; set one only where there is none."""
    if not spark.sparkContext.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(base or scratch_dir(spark, "checkpoint"))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is started inside gives its shuffle files back when it has run, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a compressed table in the shared folder, reread: for what is too wide for a checkpoint or read twice.

    Its true size is known to the plans that read it.
    """
    path = scratch_dir(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
