"""Session construction and the shared (cluster-visible) working folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults aimed at a large cluster; local runs override the partition count.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Per-quarter tables are hash-partitioned by ticker for their windows; let
    # the (ticker, fiscal_period) joins reuse that instead of re-shuffling.
    # Safe here: after aggregation a ticker holds only its quarters.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app: str = "quarterline",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with AQE on and the UI off.

    ``master`` defaults to ``$QL_MASTER`` or ``local[8]``; on a cluster pass
    the value the resource manager expects (or leave it to spark-submit by
    passing ``master=""``).
    """
    master = os.environ.get("QL_MASTER", "local[8]") if master is None else master
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20, max_partitions: int = 100_000) -> dict[str, str]:
    """Settings sized to the input volume, for ``build_session(conf=...)``.

    Shuffles start with about one partition per ``partition_bytes`` of
    input (AQE then coalesces small ones and splits skewed ones), scans
    read splits of the same size, and anything under 64 MB measured at
    runtime is broadcast.  ``max_partitions`` bounds the number of shuffle
    partitions, not the data: 100 TB is then dealt out in parts of ~1 GB.
    """
    initial = max(200, min(max_partitions, input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder every executor can see: ``spark.checkpoint.dir``, the same in every session.

    On a cluster its operator sets that to shared storage.  Only in a plain
    local session (tests) where it is unset is a private folder made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        base = sc.getCheckpointDir()
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
            base = tempfile.mkdtemp(prefix="quarterline-")
            sc.setCheckpointDir(base)
            base = sc.getCheckpointDir() or base
    return "/".join([base.rstrip("/"), *parts])


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A new folder's path in the shared folder; what is written there goes when this process ends."""
    path = shared_dir(spark, *parts[:-1], f"{parts[-1]}-{uuid.uuid4().hex}")
    _SCRATCH.append((spark, path))
    return path


@atexit.register
def _remove_scratch() -> None:
    for spark, path in _SCRATCH:
        with contextlib.suppress(Exception):  # the session may have ended
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
