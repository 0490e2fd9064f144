"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on; all of them can be changed in a running session.
RUNTIME_SETTINGS = {
    # Times are zone-free UTC; text with an offset is converted on reading.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over tasks by the size of what was shuffled, even where the split
    # costs a further exchange for a later step.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("txlake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        # Building a wide projection is much faster on the driver without a stack trace per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in spark.checkpoint.dir.

    Only a local session may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="txlake-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def workspace(spark: SparkSession, name: str) -> str:
    """New, unused folder for one run of one job."""
    return f"{shared_folder(spark)}/txlake/{name}-{uuid.uuid4().hex}"
