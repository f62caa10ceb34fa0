"""Session construction and the shared scratch location.

Materialised intermediates (checkpoints, landed pages, stream state) must
live on storage every executor can reach.  The cluster names that place in
``spark.checkpoint.dir``; we read it from the session and only fall back to
a fresh local directory when the session runs in local mode and nothing is
set (tests, the single-node bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_SHUFFLE_KEY = "spark.sql.shuffle.partitions"

#: Settings of a new session where nothing else is given.
_DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wordstats") -> SparkSession:
    """A session configured for these workloads.

    AQE stays on: it coalesces the many near-empty shuffle partitions the
    tiny frequency aggregates produce, and it re-plans joins to broadcast
    when a shuffled side turns out to be small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    started = SparkSession.getActiveSession() is not None
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WORDSTATS_DRIVER_MEMORY",
                                                      _default_driver_memory()))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    given = spark.sparkContext.getConf()
    for key, value in _DEFAULTS.items():
        # What the deployment set, and the settings of a running session, stay.
        if not started and not given.contains(key):
            spark.conf.set(key, value)
    if (not shuffle_partitions and _is_local(spark)
            and not spark.sparkContext.getConf().contains(_SHUFFLE_KEY)):
        # Only a local session for which nothing was set: one partition per
        # core.  On a cluster the deployment's setting stays (size it so a
        # partition is ~100-200 MB at the target scale); AQE coalesces what
        # turns out small.
        spark.conf.set(_SHUFFLE_KEY, str(os.cpu_count() or 8))
    ensure_checkpoint_dir(spark)
    return spark


def _default_driver_memory() -> str:
    """Half of physical memory, at most 16 GB (local runs: the driver is
    the whole engine)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, total // 2 // 2**30))}g"


def _is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local-cluster`` isn't)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(_CHECKPOINT_KEY, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared location is required "
            "on a cluster")
    path = tempfile.mkdtemp(prefix="wordstats-ckpt-")
    spark.conf.set(_CHECKPOINT_KEY, path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique directory under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/wordstats-{name}-{uuid.uuid4().hex[:12]}"
