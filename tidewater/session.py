"""Session construction and the shared checkpoint folder.

The library never picks a machine-local folder on a cluster: the checkpoint
folder comes from ``spark.checkpoint.dir``.  Only a local-mode session (tests,
bench) without that setting gets a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime re-plan to a broadcast hash join only below this measured size
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # target ~256 MB per shuffle partition after AQE coalescing, and per scan split
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidewater", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_shuffle_partitions(shuffle_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Shuffle partitions for a stage moving ``shuffle_bytes``: ~256 MB each
    before AQE coalescing, so a 100 TB scan's aggregate gets ~400k reducers
    at most and a task's partition fits executor memory without spilling."""
    return max(1, -(-shuffle_bytes // target_bytes))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only in local mode."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext on the client)
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if conf_dir:
            return conf_dir
        if not str(spark.conf.get("spark.master", "")).startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder for checkpoints")
        return tempfile.mkdtemp(prefix="tidewater-ckpt-")
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder for checkpoints")
    scratch = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def scratch_root(spark: SparkSession) -> str:
    """A folder for published tables and ledgers when the caller gives none.

    Lives next to the checkpoints so that it is shared on a cluster.
    """
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    root = os.path.join(os.path.dirname(base.rstrip("/")), "tidewater-tables")
    return root
