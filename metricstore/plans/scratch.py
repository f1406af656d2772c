"""Shared scratch locations for written intermediate tables.

Everything a job writes to cut lineage or to hand data between stages goes
below the folder the cluster names in ``spark.checkpoint.dir`` (a shared file
system).  Only a local-mode session without that setting gets a private
temporary folder, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_private: dict[str, str] = {}  # application id -> private folder of a local session


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        context = spark.sparkContext
    except Exception as exc:  # noqa: BLE001 - no local SparkContext to fall back on
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster") from exc
    root = context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not (context.master or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    # the session itself keeps its settings
    if context.applicationId not in _private:
        _private[context.applicationId] = tempfile.mkdtemp(prefix="metricstore-checkpoint-")
    return _private[context.applicationId]


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder, new for each call by default."""
    suffix = f"-{uuid.uuid4().hex[:12]}" if unique else ""
    return f"{checkpoint_root(spark)}/metricstore/{name}{suffix}"
