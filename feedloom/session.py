"""Session helpers: local sessions for tests/bench and the shared checkpoint folder.

Library functions never create sessions; they take DataFrames.  Jobs that must
cut lineage read ``spark.checkpoint.dir`` from the running session.  Only a
local session (tests, bench) may fall back to a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally.  AQE re-plans joins from
# runtime sizes (a broadcast only happens when the measured side is below the
# threshold), splits skewed shuffle partitions and coalesces tiny ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "feedloom", extra: dict | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FEEDLOOM_DRIVER_MEMORY", "16g"))
        # Two reduce tasks per core balanced best in local measurements; on a
        # cluster size this from input bytes (see README) and let AQE coalesce.
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 2 * cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only locally."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor shares")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="feedloom-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/feedloom-{name}-{uuid.uuid4().hex}"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """What a task opens a file under the shared checkpoint folder with."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def materialize(df, name: str = "table"):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used where several consumers read one expensive intermediate: the write cuts
    the lineage (a lost executor re-reads files instead of recomputing the
    pipeline) and the re-read still prunes columns per consumer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
