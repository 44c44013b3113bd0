"""Session helpers.

Library code never creates a session; it only reads settings from the one it is
given. ``local_session`` exists for tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def use_utc(spark: SparkSession) -> None:
    """All calendar keys (day, hour, month) are computed in UTC, as in the reference."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Where it is unset a
    local session takes a folder under the warehouse; on a cluster that folder may
    be a machine's own, so there the setting is asked for.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's own spark.checkpoint.dir applies
        return spark.conf.get(CHECKPOINT_CONF, None) or ""
    path = sc.getCheckpointDir()
    if path:
        return path
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all machines share")
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cluster_conf(input_bytes: int, total_cores: int, partition_mb: int = 256) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet/JSON input.

    Shuffle partitions start at about one per ``partition_mb`` of input (at
    least two per core), so a shuffled fact has partitions of that size at any
    scale; AQE coalesces what turns out smaller.  Scan splits use the same size; skewed join partitions are split;
    reliable checkpoints are cleaned when their DataFrame goes away.
    ``spark.checkpoint.dir`` is left to the cluster (a shared folder).
    """
    mb = 1024 * 1024
    shuffle = max(2 * total_cores, -(-input_bytes // (partition_mb * mb)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clipstat") -> SparkSession:
    """Session for tests and the benchmark (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CLIPSTAT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="clipstat-ckpt-"))  # local test session only
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
