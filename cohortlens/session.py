"""Session helpers: a tuned local session for tests/bench and checkpoint-dir lookup."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cohortlens") -> SparkSession:
    """Create (or reuse) a session with the settings this library assumes.

    AQE is on so that shuffle partitions coalesce and skewed join partitions are
    split at run time; ``shuffle_partitions`` is where coalescing starts, so set it for the
    largest table (tests and bench pass a small one).  The session time zone is UTC so that
    DATE arithmetic never depends on the host.
    """
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("SHUFFLE_PARTITIONS", "200"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared (HDFS/object-store) folder; without it this
    raises, as a folder of one machine would be lost to the others.  Only in local mode,
    where one process holds driver and executors, a scratch folder stands in.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def free_shuffles(spark: SparkSession) -> None:
    """Has the driver collect its garbage: only then does Spark delete the shuffle files of frames that nobody holds any more,
    and a run that checkpoints large frames on its way would keep all of them on disk."""
    spark.sparkContext._jvm.System.gc()
