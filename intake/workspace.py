"""Where a run may write: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_DIR = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, visible to every executor.

    Only a local-mode session without that setting gets a temporary folder: there
    the driver is the only machine. On a cluster a missing setting is an error.
    """
    named = spark.conf.get(SHARED_DIR, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local"):
        app = context.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="intake-")
        return _local_dirs[app]
    raise ValueError(f"set {SHARED_DIR} to a folder that all executors can reach")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name for one run; nothing is reused or cleared."""
    return f"{shared_dir(spark)}/intake/{label}-{uuid.uuid4().hex[:12]}"
