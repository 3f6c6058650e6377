"""Session construction and shared storage locations.

Library code never creates a session by itself; operators take DataFrames. These helpers are for
tests, the benchmark and command-line use.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "flightlake") -> SparkSession:
    """Session with AQE on, UTC, Arrow enabled and the UI off.

    Master, partitions and memory stay as the deployment (``spark-submit``) sets them unless they are
    given here; a local master gets one shuffle partition per core and a large driver heap.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        cores = re.sub(r"\D", "", master) or os.environ.get("BENCH_CPUS", "8")
        builder = builder.config("spark.sql.shuffle.partitions", cores).config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_master() -> str:
    """The master of tests and benchmarks."""
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``, used as is.

    Only a local master may do without: it gets a fresh temporary folder. Anywhere else other machines
    could not see that folder, so a missing setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="flightlake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder (one per call)."""
    return f"{shared_root(spark)}/flightlake/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, executor_cores: int = 1000 * 8, partition_bytes: int = 128 << 20) -> dict:
    """Settings for a cluster run sized from the bytes the jobs read.

    * shuffle partitions: enough that each holds about ``partition_bytes`` of the input (and at least
      two per core); AQE then coalesces small ones at runtime, so over-provisioning is cheap while
      under-provisioning spills;
    * scan splits of 256 MB, AQE advisory size ``partition_bytes``;
    * skew join: a partition five times the median and above 256 MB is split;
    * streaming state in RocksDB (spills to local disk instead of holding all state on the heap).
    """
    shuffle = max(2 * executor_cores, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.session.timeZone": "UTC",
    }
