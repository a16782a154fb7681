"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # long texts are held outside the heap, in buffers of twice their size that stay, and again in the Python worker
    "spark.sql.execution.arrow.maxBytesPerBatch": "1m",
    # recording the call site of every column expression makes building large plans several times slower
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "colonnade", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``master`` is for local runs, a cluster sets its own."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings above on an existing session, as far as it lets them be changed."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables: the one the cluster names, else a local one (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table several later steps read, and read it back: it is computed once and survives lost executors.

    The table lies in the shared folder, so the plans of later steps start from its columns and statistics.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
