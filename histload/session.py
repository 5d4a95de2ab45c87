"""Session helpers: the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local: list[tempfile.TemporaryDirectory] = []  # removed when this process ends


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    _local.append(tempfile.TemporaryDirectory(prefix="histload-", ignore_cleanup_errors=True))
    spark.sparkContext.setCheckpointDir(_local[-1].name)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path for an intermediate table."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
