"""SparkSession settings the library relies on, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session running the attribution should carry.  AQE re-plans
# joins at runtime (broadcast when a side is measured small, skew-join split of
# hot keys); UTC keeps day boundaries and micro-second epochs stable.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "touchcredit",
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local session for tests, examples and the benchmark."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make reliable checkpoints usable and return their folder.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system); it is only invented here, under the local temp folder, when
    the session has none, as in tests and local runs.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="touchcredit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def cluster_conf(input_bytes: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Settings for a cluster run over ``input_bytes`` of export Parquet.

    Shuffle partitions start at one per ``target_partition_bytes`` of input and
    AQE merges small ones, so a shuffle of the whole export has partitions of
    that size.  ``AttributionConfig.chunk_rows`` bounds what one user puts into
    one task, and so (rows / chunk_rows) every broadcast of the ordered stages.
    Scan splits match the target size so one task never decodes more than about
    that much Parquet.
    """
    n = max(200, -(-input_bytes // target_partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
