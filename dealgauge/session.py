"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A session for tests and the benchmark. On a cluster the submitter makes the session."""
    builder = (
        SparkSession.builder.master(master)
        .appName("dealgauge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for checkpoints and written stages.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may go without:
    then driver and executors are one process and a temporary folder is shared by nature.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="dealgauge-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")
