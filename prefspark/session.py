"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


# Adaptive execution splits hot partitions, and hashes a join input whose partitions are all small
# instead of sorting both inputs.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def local_session(cores: int | str = "*", app: str = "prefspark", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in (ADAPTIVE | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the configured one, else a folder in the warehouse."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return spark.conf.get(WAREHOUSE_DIR).rstrip("/") + "/prefspark-runs"


def new_workdir(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, removed with everything in it when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    # The file system only notes folders that exist.
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path
