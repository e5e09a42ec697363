"""Session defaults for tests and benchmarks; a cluster brings its own session."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tracebook", cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session with adaptive execution on and the UTC clock."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def checkpointed(df: DataFrame) -> DataFrame:
    """Store an intermediate result that several consumers read, and cut its lineage there.

    The files go to the shared folder named by ``spark.checkpoint.dir``, so they outlive
    executors. Only a local session that names none, as in tests, gets a folder of its own.
    """
    session = df.sparkSession
    context = session.sparkContext
    if context.getCheckpointDir() is None:
        folder = session.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()
