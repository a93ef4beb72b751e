"""Session helpers: a configured SparkSession and the shared work folder.

On a cluster the work folder is whatever ``spark.checkpoint.dir`` names
(a shared filesystem path).  Only when that setting is absent — local
tests — do we create a private temporary folder and register it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def _driver_gb(cap: int = 16) -> int:
    """Local-mode heap: 60% of physical memory, at most ``cap`` GB (the driver is the executor)."""
    try:
        phys = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return 4
    return max(1, min(cap, int(phys * 0.6) >> 30))


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a data volume: shuffle partitions so each reducer gets about
    ``target_partition_bytes`` (at least 2 waves of all cores), scan splits of the same
    size, AQE coalescing toward it and skew splitting above 4× it.

    e.g. 100 TB on 1000 executors × 8 cores -> ~400k shuffle partitions of 256 MB.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def get_spark(master: str | None = None, app: str = "rsvpflow", partitions: int | None = None,
              input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Return a session tuned for the library (AQE on, UTC, no UI).

    With ``input_bytes`` / ``total_cores`` the shuffle and scan sizes follow ``scale_conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    conf = {
        "spark.sql.shuffle.partitions": str(partitions or cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # skip per-call Python stack capture for error context (driver-side plan-building cost)
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": f"{_driver_gb()}g",
    }
    if input_bytes:
        conf.update(scale_conf(input_bytes, total_cores or cores))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_PRIVATE_ROOTS: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for snapshots / checkpoints.

    Read from ``spark.checkpoint.dir`` (a static setting the cluster provides).  Only when the
    session names none — local tests — a private temporary folder is registered as the
    SparkContext checkpoint directory (the setting itself cannot be changed at runtime).
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not re.match(r"local($|\[)", getattr(spark.sparkContext, "master", "local")):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set: on a cluster it must name a folder that all executors share")
        key = id(spark.sparkContext)
        if key not in _PRIVATE_ROOTS:
            _PRIVATE_ROOTS[key] = tempfile.mkdtemp(prefix="rsvpflow-ckpt-")
        root = _PRIVATE_ROOTS[key]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
