"""Session helpers: a local session for tests and the bench, and the shared work folder.

Jobs that must cut lineage or keep streaming state write under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "spindle") -> SparkSession:
    """A local-mode session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPINDLE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Checkpoint files of DataFrames that are no longer referenced are removed from the shared folder.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Streaming state (the exact histogram grows with distinct items) lives off-heap and spills to disk.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only for a local-mode session that has none.

    On a cluster a machine-local folder would not survive the loss of the machine, so the session must name a
    shared folder in ``spark.checkpoint.dir``.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for this cluster session")
        current = tempfile.mkdtemp(prefix="spindle-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder, unique per call."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "spindle", *parts, uuid.uuid4().hex])


def spread(df, partitions: int | None):
    """``df`` dealt round-robin over ``partitions``; unchanged without a number.

    Iterative jobs scan their cached input once per round, so an input read as a handful of splits (a file with a
    single row group) would keep most cores idle.  The number is the caller's: asking the plan for its own would run
    its shuffles under adaptive execution.
    """
    return df.repartition(partitions) if partitions else df
