"""Session settings and the shared work folder used by jobs that write tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_work_root: str | None = None


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans rely on; ``master`` is for tests and bench only."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables and stream checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only on one machine (a local master) is a
    folder of our own made where that is unset; elsewhere that is an error, because executors would
    not see the driver's disk.
    """
    global _local_work_root
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_work_root is None:
        _local_work_root = tempfile.mkdtemp(prefix="holdfast-")
    return _local_work_root


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below :func:`work_root`; nothing is reused between runs."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
