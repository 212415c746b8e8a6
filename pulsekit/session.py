"""SparkSession helpers.

The library itself never builds a session: every operator takes a DataFrame. These helpers exist for scripts, tests
and the bench, and for the one cluster setting operators need, the checkpoint folder.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Defaults that hold at any scale: AQE re-plans shuffles at runtime (coalesces small partitions, splits skewed join
# partitions), the UI server stays off, and time is UTC so timestamp_ntz arithmetic never depends on the host zone.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Sizing for large clusters (100 TB class inputs): shuffles start wide and AQE coalesces them to ~256 MB partitions,
# scans split files into 256 MB tasks, skewed join partitions are split, and checkpoint files (written by the ordered
# statistics) are deleted once their DataFrames are garbage-collected. spark.checkpoint.dir must name a shared folder.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# A local driver in a container must both bind to and advertise loopback, or large task results get lost.
LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
}


def get_spark(master: str | None = None, app_name: str = "pulsekit", shuffle_partitions: int | None = None,
              conf: dict | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the library defaults; ``master`` is only set when given.

    ``cluster=True`` adds ``CLUSTER_CONF`` (partition sizing for very large inputs).
    """
    builder = SparkSession.builder.appName(app_name)
    settings = dict(DEFAULT_CONF)
    if cluster:
        settings.update(CLUSTER_CONF)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            settings.update(LOCAL_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint folder of the session, setting it on the context if needed.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that always wins. Only when it is unset and the
    master is local (tests) do we create one, under ``fallback`` or a fresh temporary folder; a cluster without the
    setting is an error rather than a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.match(r"local(\[|$)", sc.master):  # one process; local-cluster and clusters need a shared folder
        base = fallback or tempfile.mkdtemp(prefix="pulsekit-ckpt-")
        os.makedirs(base, exist_ok=True)
        sc.setCheckpointDir(base)
    else:
        # A folder on one machine is invisible to the other executors and vanishes with them.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) for this cluster")
    return sc.getCheckpointDir()
