"""Spark session factory and shared-storage helpers.

Only plumbing lives here: a session with UTC, AQE and sane local defaults,
and a way to obtain a *shared* scratch folder for writes and checkpoints.
On a cluster the scratch folder is derived from ``spark.checkpoint.dir``,
which the cluster operator points at shared storage; we only pick our own
folder when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window stages are compute-heavy for their shuffle size (a few MB of
    # observations fan out into many indicator columns); a smaller floor for
    # coalesced partitions keeps such stages parallel. Large stages are sized
    # by the advisory partition size and are unaffected.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_spark(app_name: str = "indicata", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session with UTC time and AQE switched on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a local one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value
    always wins, and a cluster session without it is an error, as every
    machine would write to its own disk. Local runs and tests get a fresh
    folder under the system temp directory. Works with a classic session (SparkContext) and with a
    Spark Connect session (conf only).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master!r} share")
        configured = tempfile.mkdtemp(prefix="indicata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used by operators that must write and read back (bronze appends,
    partition overwrites, control logs) so that every run gets its own
    folder and nothing is shared between concurrent runs.
    """
    base = ensure_checkpoint_dir(spark)
    return _join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def _join(base: str, leaf: str) -> str:
    if "://" in base:
        return base.rstrip("/") + "/" + leaf
    return os.path.join(base, leaf)
