"""Session helpers: a local session for tests/bench and the shared scratch root.

On a cluster the session comes from the platform; the library only reads
``spark.checkpoint.dir`` from it. A directory of our own is set only when
that setting is missing (local tests).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

SCRATCH_SUBDIR = "stocktake"
# Keys that a task's aggregate holds in its hash map before it goes on by sorting (which spills): some
# 100 MB of heap, where Spark's own limit is 128 keys.
HASHED_KEYS = {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "200000"}
# Checkpoint folder of a local master where none is configured (tests, a laptop).
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints/stocktake"


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "stocktake") -> SparkSession:
    """Local session with the settings the library is designed around.

    AQE stays on so that shuffle partitions coalesce and skewed partitions
    of the sort-merge fallbacks are split at run time.
    """
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config(map=HASHED_KEYS)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_session(app: str = "stocktake") -> SparkSession:
    """Session for spark-submit: master, executors and memory come from the launcher.

    Only query semantics are set here (UTC session time, AQE with skew splits,
    per-partition overwrite); the checkpoint folder is read from the cluster's
    ``spark.checkpoint.dir``.
    """
    spark = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config(map=HASHED_KEYS)
        .getOrCreate()
    )
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # not readable as a session conf in some deployments
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:
        # Spark Connect: no driver-side context; the folder must come from the server's conf.
        configured = _conf_checkpoint_dir(spark)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        # A machine-local folder is not visible to other executors: never fall back to one on a cluster.
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    path = configured or LOCAL_CHECKPOINTS
    sc.setCheckpointDir(path)
    current = sc.getCheckpointDir() or path
    _delete_on_exit(spark, current)
    return current


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the folder removed when the driver ends: scratch of this session only (its name is unique)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def scratch_root(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint location for job-written tables."""
    try:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # Spark Connect
        base = _conf_checkpoint_dir(spark)
    base = base or ensure_checkpoint_dir(spark)
    root = f"{base.rstrip('/')}/{SCRATCH_SUBDIR}/{uuid.uuid4().hex}"
    try:
        _delete_on_exit(spark, root)
    except Exception:  # Spark Connect: the server's own clean-up applies
        pass
    return root
