"""Session settings and the shared folder used for checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "penprint", cores: str | int = "*", **conf) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(os.cpu_count() or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Token lists are grouped per document; partitions bound their memory, so
        # more than the default 128 documents may be open before Spark sorts.
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    ``spark.checkpoint.dir`` wins. Without it a local session gets a scratch
    folder; a cluster must name a folder all its executors can reach.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="penprint-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the checkpoint folder, for sinks and stream state."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
