"""Session set-up and shared-storage materialisation."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_MASTER_PREFIX = "local"
#: Setting by which Spark removes the shuffle files of a write, or another action, at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_private_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(app: str = "barflow", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks. On a cluster, use the session the cluster gives you."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BARFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a private temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith(LOCAL_MASTER_PREFIX):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _private_dirs:
        _private_dirs[app] = tempfile.TemporaryDirectory(prefix="barflow-", ignore_cleanup_errors=True)
    return _private_dirs[app].name


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan of fewer splits than cores over all cores of a local session before costly work on its rows.

    On a cluster the scan is left as it is: size its splits instead, with ``spark.sql.files.maxPartitionBytes``.
    """
    if not df.sparkSession.sparkContext.master.startswith(LOCAL_MASTER_PREFIX + "["):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage, survives executor loss and keeps column pruning and filter push-down for the
    passes that follow. What the write shuffled goes when it ends: nothing reads it again, and until the driver collects
    its garbage the shuffles of all tables would stay on disk together.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
