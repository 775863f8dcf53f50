"""Session settings and the shared scratch location.

Library functions never create a session of their own; they take the one
the caller built.  ``get_session`` is for tests, the bench and scripts.
``configure`` only sets values the cluster has not set already, so a
production session keeps its own partition counts and memory settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every report relies on.  Values are set only when absent.
DEFAULTS = {
    # Timestamps in the inputs carry no zone; keep wall-clock values.
    "spark.sql.session.timeZone": "UTC",
    # Overflow and bad casts raise instead of turning silently into NULL.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn joins into broadcasts once a side is measured.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast joins only from measured sizes: AQE turns a join into a
    # broadcast once the materialised shuffle of one side is under this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}

# The plan-time broadcast uses a file-size estimate (compressed bytes), not a
# proven bound, so it is switched off unless the cluster chose a value other
# than Spark's default.  Dimension sides are broadcast explicitly after a
# check of rows and bytes (operators.joins.broadcast_if_small).  A cluster that
# wants Spark's default of 10 MB has to write it in another unit (10240k).
STATIC_BROADCAST_KEY = "spark.sql.autoBroadcastJoinThreshold"
SPARK_DEFAULT_STATIC_BROADCAST = ("10485760", "10485760b", "10MB", "10m")


def configure(spark: SparkSession) -> SparkSession:
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    if spark.conf.get(STATIC_BROADCAST_KEY, None) in (None, "", *SPARK_DEFAULT_STATIC_BROADCAST):
        spark.conf.set(STATIC_BROADCAST_KEY, "-1")
    # The defaults above are only applied where missing, except the zone:
    # month keys and day counts must not depend on the host's zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlens") -> SparkSession:
    """Local/test session.  On a cluster, build the session there and call
    ``configure`` on it instead."""
    cores = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.warehouse.dir", _local_dir("warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={_local_dir('derby')}")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config(STATIC_BROADCAST_KEY, "-1")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    scratch_root(spark)
    return spark


_LOCAL_BASE: str | None = None


def _local_dir(name: str) -> str:
    """Per-process folder under /tmp for sessions built by ``get_session``
    (tests and local runs only)."""
    global _LOCAL_BASE
    if _LOCAL_BASE is None:
        _LOCAL_BASE = tempfile.mkdtemp(prefix="ledgerlens-")
    path = os.path.join(_LOCAL_BASE, name)
    os.makedirs(path, exist_ok=True)
    return path


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged files and lineage cuts.

    It is the cluster's ``spark.checkpoint.dir``.  Only a local session that has
    none gets a local folder; executors on other hosts could not see it, so
    anywhere else a missing folder is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        root = _local_dir("checkpoints")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def is_local(master: str | None) -> bool:
    """Whether tasks run in the driver's own process (not ``local-cluster``)."""
    return master is not None and (master == "local" or master.startswith("local["))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared scratch folder."""
    return f"{scratch_root(spark)}/ledgerlens-{name}-{uuid.uuid4().hex[:12]}"
