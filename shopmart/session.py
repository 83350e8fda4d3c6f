"""Session helpers.

Cluster jobs get their session from ``spark-submit``; these helpers only
fill in settings that are missing, so a cluster's own configuration
(checkpoint folder, shuffle partitions, memory) always wins.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs expect (Spark 4 defaults, stated so a session that turned
# them off gets them back where unset): AQE re-plans joins, coalesces
# partitions and splits skewed join partitions at run time.  Results do not
# depend on the session time zone (all timestamps are zone-free) nor on AQE
# (tested with it off).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "shopmart", extra_conf: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, no server)."""
    master = master or os.environ.get("SHOPMART_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SHOPMART_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


TASK_ROWS = 1 << 18     # raw rows that a task of a join, an aggregate or a window is given; the driver keeps tasks times tasks sizes for each exchange
MOST_PARTITIONS = 1 << 13
MERGED_TASKS = 8        # tasks' rows that may still be merged into one


def sized_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session whose exchanges are cut as finely as ``rows`` raw rows call for.

    A task sorts and hashes one partition of every step it holds, so with a fixed number of partitions
    its memory grows with the input.  So it does with a large number, when AQE merges the partitions down to
    the cores or by their compressed size (which says little: a MB may be 60 in a sort).  When the caller's number
    gives a task more than ``TASK_ROWS`` rows, or merging might give it more than ``MERGED_TASKS`` times as many, a
    new session of the same context takes over the caller's settings with as many partitions as the rows call for,
    not merged.  Files are read in as many pieces, as a task that writes to an exchange holds its piece.  Otherwise,
    and over Spark Connect, the session stays as it is.  The caller's settings are not touched.
    """
    parts = min(MOST_PARTITIONS, -(-rows // TASK_ROWS))
    merged = all(spark.conf.get(key, "true").lower() == "true" for key in (
        "spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled"))
    enough = parts <= int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if enough and (parts <= MERGED_TASKS or not merged) or not hasattr(spark, "_jsparkSession"):
        return spark
    sized = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sized.conf.set(key, value)
    sized.conf.set("spark.sql.shuffle.partitions", str(parts))
    sized.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sized.conf.set("spark.sql.files.minPartitionNum", str(parts))
    return sized


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of the queries run inside go as soon as each ends, not when the driver collects garbage.

    For jobs whose answer alone counts.  A query of another thread that starts meanwhile loses its files at its end too.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


_LOCAL_FOLDERS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage-cutting tables: ``spark.checkpoint.dir``.

    Read from the session (config first, then the context's checkpoint
    folder).  Only when it is unset and the master is local is a temporary
    folder made — never on a cluster, where a machine-local folder would not
    be shared.  Works on classic and Connect sessions.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    master = spark.conf.get("spark.master", "") or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    key = master + (sc.applicationId if sc is not None else "")
    if key not in _LOCAL_FOLDERS:
        path = tempfile.mkdtemp(prefix="shopmart-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(path)
            path = sc.getCheckpointDir()
        _LOCAL_FOLDERS[key] = path
    return _LOCAL_FOLDERS[key]
