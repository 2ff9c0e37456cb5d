"""Session helpers: a sensible local session for tests and the bench, and the
shared folder used for staging and lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tabflow") -> SparkSession:
    """Local session with AQE on and the UI off (tests, bench, examples).

    On a cluster, use the session the cluster gives you instead; nothing in the
    library depends on these settings except for speed.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TABFLOW_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None when the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Staged tables and lineage cuts go below it, so every executor (and a
    re-tried task on another host) sees the same files. If the setting is
    missing we only invent one in local mode (tests); on a cluster we refuse,
    because a machine-local temporary folder would lose data with an executor.
    """
    sc = _context(spark)
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) first")
        path = tempfile.mkdtemp(prefix="tabflow-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # core config may be read-only at runtime
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")
