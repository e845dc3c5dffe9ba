"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone is pinned because timestamps in the
# driver tables are zone-less; AQE re-plans joins (broadcast only when the
# materialised side is under the threshold) and splits skewed partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even when that costs an extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "casework", extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a configured one if needed.

    On a cluster the master and partition counts come from spark-submit;
    locally (tests, bench) they default to ``local[*]`` and 8 partitions.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("CASEWORK_MASTER", "local[*]"))
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a cluster run: enough initial partitions that each
    holds about ``target_partition_bytes`` of the largest input (and at
    least three waves of tasks); AQE then coalesces small ones and splits
    skewed ones at run time.
    """
    initial = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir``.

    A private scratch folder is created only for ``local[...]`` sessions
    without the setting (tests, single-machine runs). On a cluster the
    setting must name a shared folder; a machine-local default would be lost
    with its executor, so its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="casework-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
