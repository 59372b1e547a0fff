"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "pulsegrid",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, ANSI mode and AQE on.

    On a cluster the master and memory come from spark-submit; locally the
    caller passes ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
         # checkpointed intermediates (value histograms, Bronze take-backs)
         # are deleted once no longer referenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root folder for intermediate tables and stream checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` (a shared file system path).
    Only when it is unset in a local session (tests) a private folder is
    created and registered as the checkpoint dir; on a cluster an unset
    setting is an error, since a machine-local folder is not visible to the
    other executors and is lost with them.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if d and not jdir.isDefined():  # set on the session after the context started
        spark.sparkContext.setCheckpointDir(d)
    if not d and jdir.isDefined():
        d = jdir.get()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder on the shared file system")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pulsegrid-ckpt-"))
        d = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh, unique folder under the shared dir for one run of one job."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme so plain-Python tests can open the path."""
    if p.startswith("file:"):
        p = p[5:]
        while p.startswith("//"):
            p = p[1:]
    return os.path.abspath(p)
