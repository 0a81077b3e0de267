"""Spark session settings used by tests, the bench and local runs.

On a cluster the session comes from the job launcher; ``tune`` only sets
what is safe to set at runtime and leaves cluster-given values alone.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Times are TIMESTAMP_NTZ throughout; UTC keeps any LTZ literal honest.
    "spark.sql.session.timeZone": "UTC",
    # Broadcast a data-sized side only when its measured (runtime) size is
    # small; never from compile-time estimates.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


# Settings meant for a large cluster reading the full tables (set by the job
# launcher; listed here so the sizing is written down next to the code).
CLUSTER_CONF = {
    **RUNTIME_CONF,
    "spark.sql.shuffle.partitions": "4000",  # upper bound; AQE coalesces to the advisory size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a launcher's session."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ticketflow") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when
    the cluster named none (local runs and tests)."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if cur:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(cur)
        return cur
    path = tempfile.mkdtemp(prefix="ticketflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path
