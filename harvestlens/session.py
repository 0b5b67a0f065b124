"""Spark session helpers.

Library code never creates a session on its own; it takes the caller's.
``local_session`` exists for tests, the bench and the smoke entry.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on (pinned for comparisons with other engines).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "harvestlens") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("HL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # window-heavy stages (the mart) are CPU-bound on few bytes: let AQE
        # keep small shuffle partitions instead of merging them into one task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder: the one ``spark.checkpoint.dir`` names, else the
    one set on the context.

    On a cluster the deployment gives one of them, on shared storage; only a local master
    without either gets a temporary folder of its own (tests).
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="hl-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


_SCRATCH: dict[str, SparkSession] = {}


def scratch(spark: SparkSession, prefix: str = "scratch") -> str:
    """A new folder name below the shared checkpoint folder; what is written there goes when
    the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH[path] = spark
    return path


def stored(df: DataFrame, prefix: str = "table") -> DataFrame:
    """``df`` written once below the shared folder and read back: lineage is cut, and what
    is read of it later is pruned and filtered at the scan."""
    path = scratch(df.sparkSession, prefix)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove_scratch() -> None:
    for path, spark in _SCRATCH.items():
        sc = spark.sparkContext
        if sc._jsc is not None:  # the context may have been stopped
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
