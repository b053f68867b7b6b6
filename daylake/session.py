"""Session helpers: building a session and finding the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every daylake session wants; the cluster's own values win when set.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    # A lake has one folder per day: list folders with a bounded number of tasks
    # instead of one task per folder (the default parallelism is 10 000).
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.ui.showConsoleProgress": "false",
}


# Local runs only: opening a local file is cheap, so many small day files may share a task.
LOCAL_CONF = {
    "spark.sql.files.openCostInBytes": str(64 * 1024),
    "spark.driver.memory": "16g",
}


def get_spark(app: str = "daylake", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if master and master.startswith("local"):
        for key, value in LOCAL_CONF.items():
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune_for_day_folders(spark: SparkSession) -> None:
    """Runtime settings for lakes with one folder per day, applied only where the
    session still has Spark's defaults (a cluster's own choice is kept).

    * listing parallelism: bounded by the cluster's parallelism instead of one
      task per folder;
    * local master only: small files may share a task (opening a local file is cheap).
    """
    conf = spark.conf
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if conf.get(key, "10000") == "10000":
        conf.set(key, str(max(8, min(1024, spark.sparkContext.defaultParallelism * 4))))
    key = "spark.sql.files.openCostInBytes"
    if spark.sparkContext.master.startswith("local") and conf.get(key, "4194304") in ("4194304", "4m", "4MB"):
        conf.set(key, LOCAL_CONF[key])


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach; it is
    read from the session.  Only where it is unset (local tests) a folder of
    our own is created and set, so ``checkpoint()`` works there too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="daylake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder below the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/daylake/{tag}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local tooling (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
