"""Session construction and cluster-wide settings.

The defaults switch on adaptive query execution so that joins pick broadcast
only after the runtime size of a side is known (``autoBroadcastJoinThreshold``
is the size check), skewed join partitions are split, and rebalance hints can
split hot keys when writing.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints written by numbering and split steps are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_conf(input_bytes: int, total_cores: int,
                 partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Partition sizing for a given input volume and cluster size.

    Scan splits and post-shuffle partitions target ``partition_bytes`` (a size
    a task sorts or aggregates comfortably within executor memory).  The
    initial shuffle partition count covers the input at that size (at least
    two waves of the cluster's cores) and AQE coalesces what
    turns out smaller; skew splitting starts at 4x the target size.
    """
    parts = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def build_session(master: str | None = None, app_name: str = "encore",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None,
                  input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults applied.

    With ``input_bytes`` and ``total_cores`` the partition sizing of
    ``cluster_conf`` is applied as well.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if input_bytes and total_cores:
        settings.update(cluster_conf(input_bytes, total_cores))
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, required=False)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, required: bool = True) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a single-process ``local`` session without that setting gets a scratch
    folder of its own: there the driver and the executors are one machine.  Any
    other master without the setting raises, because a machine-local folder
    would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder and re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        folder = tempfile.mkdtemp(prefix="encore-ckpt-")
    if not folder:
        if not required:
            return None
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                           "(lineage cuts and intermediate tables are written there)")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, without the per-application part."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return named or ensure_checkpoint_dir(spark)
