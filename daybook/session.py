"""Session helpers for tests, the bench and command-line runs.

Library operators never build or reconfigure a session; they take
DataFrames.  This module only provides a sensibly configured local
session and a shared checkpoint location.
"""

from __future__ import annotations

import os
import tempfile

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every run of this library relies on.  The zone is pinned so that
# DATE <-> TIMESTAMP conversions do not depend on the machine.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what the planner has measured to be below this size;
    # everything larger goes through a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Sets per group (fraud report) stay hash-aggregated for more keys before
    # the object-hash aggregate falls back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The cluster setting wins.  Only where it is unset on a local master (tests)
    a scratch folder is created and registered; a cluster without one is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="daybook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables, under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """The results of steps that don't need each other, their jobs submitted side by side.

    Small jobs then share the cores with large ones.  All steps have ended when
    this returns or raises the error of the first one that failed.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    Scan splits and shuffle partitions are sized so one task handles about
    ``target_partition_bytes`` (fits executor memory, spills gracefully);
    AQE starts from that many shuffle partitions, coalesces small ones and
    splits skewed ones.  A multiple of the core count avoids a ragged last
    wave.  Pass the result to ``SparkSession.builder.config(map=...)``.
    """
    waves = max(1, -(-input_bytes // (target_partition_bytes * total_cores)))
    partitions = max(total_cores, waves * total_cores)
    conf = dict(REQUIRED_CONF)
    conf.update(
        {
            "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
            "spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
            # Object-hash aggregation (sets per group) spills to sort-based beyond this many keys.
            "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
        }
    )
    return conf
