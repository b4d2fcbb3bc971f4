"""Session settings for tests and benchmarks, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tidewright", **extra: str) -> SparkSession:
    """A single-machine session for tests and `bench.py`; a cluster brings its own."""
    parallel = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in extra.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def _shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`, which all executors share.

    Only a session that names none (a local test) gets a folder of its own, and that choice
    is written back so that every later call of the session uses it.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tidewright-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one."""
    return f"{_shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame's rows, computed once and kept in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_folder(spark))
    return df.checkpoint(eager=True)
