"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a local run needs; on a cluster the submitter's own settings win
# because ``getOrCreate`` keeps an existing session.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(app: str = "shelfsync", cpus: int | str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = cpus or os.environ.get("BENCH_CPUS") or "8"
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = dict(LOCAL_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    settings.setdefault("spark.driver.memory", "16g")
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables and stream checkpoints.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system every
    executor can reach).  Only when it is unset — local tests — is a private
    folder created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="shelfsync-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    return "/".join([work_dir(spark), *parts, uuid.uuid4().hex])
