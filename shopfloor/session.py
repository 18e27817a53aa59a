"""Session helpers: the configuration every job in this package expects."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the package relies on for correct results (not just speed).
REQUIRED_CONF = {
    # All timestamps are instants; render and parse them in UTC.
    "spark.sql.session.timeZone": "UTC",
    # MQTT payloads may repeat a key; the JSON object must still parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for throughput at scale; callers on a cluster may override.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Spill-aware sizes for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at input / target (AQE then coalesces small ones
    and splits skewed ones); scan splits stay at 256 MB; never fewer
    partitions than cores."""
    parts = max(cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        **TUNING_CONF,
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "shopfloor", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's session and call
    :func:`configure` on it instead."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**REQUIRED_CONF, **TUNING_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only when the session names none (local tests) a scratch folder is made,
    so lineage cuts never land in a machine-local folder on a cluster.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shopfloor-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
