"""Session helpers.

Operators never create sessions; they take DataFrames. ``local_session`` is
for tests and the benchmark only. ``checkpoint_dir`` reads the shared folder
the cluster names in ``spark.checkpoint.dir`` and only falls back to a fresh
scratch folder when the setting is absent (local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins/partition counts from
# runtime sizes and splits skewed shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.pushVariantIntoScan": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of unreferenced datasets are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for a large cluster (100 TB inputs). Start with many
# shuffle partitions and let AQE coalesce them to ~256 MB; split skewed
# partitions above 5x the median; read files in 512 MB splits. Broadcasts
# stay behind the 64 MB threshold (checked from runtime sizes by AQE).
CLUSTER_CONF = {
    **SCALE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "reelmart", extra: dict | None = None) -> SparkSession:
    """Local session for tests/bench; sets a scratch checkpoint dir if unset."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("REELMART_DRIVER_MEMORY", "16g")))
    # small local shuffles still spread over all cores (cluster: default 1MB)
    local = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB"}
    for k, v in {**SCALE_CONF, **local, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; otherwise (local
    tests) creates a fresh scratch folder and registers it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="reelmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
