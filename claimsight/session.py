"""Spark session helpers.

The library never creates its own session inside an operator; callers pass one.
``get_session`` is a convenience for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this package.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splitting handles a hot
# Policy_ID (one key may carry a large share of all claims).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "claimsight", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, executor_cores: int, executors: int,
                   target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of Parquet.

    Start with enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the largest shuffle (the claims-policies
    join moves roughly the projected input), never fewer than three waves
    of tasks; AQE then coalesces small partitions and splits skewed ones at
    run time.  Scan splits stay at 256 MB so a task's input fits comfortably
    in executor memory next to its shuffle buffers.
    """
    slots = max(executor_cores * executors, 1)
    by_size = -(-int(input_bytes) // target_partition_bytes)
    partitions = max(by_size, 3 * slots)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        # broadcast only what the planner measured to be small; our own
        # broadcasts are bounded by construction (see operators/joins.py)
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is.  Only a ``local`` master, where driver and executors are one
    process, may go without; any other master without the setting raises, as a
    machine-local folder would lose rows.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="claimsight-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
