"""Where intermediate tables and streaming checkpoints go."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder that the cluster names, removed when the application ends.

    Without that setting a local session gets a temporary folder; a cluster has no folder all of its
    machines see, so there it is an error.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder all executors can reach")
        root = _local_root()
    folder = f"{root.rstrip('/')}/heliovane-{spark.sparkContext.applicationId}"
    _remove_at_exit(spark, folder)
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="heliovane-")


_noted: set[str] = set()


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Let the driver's file system remove the folder when the application ends."""
    if folder not in _noted:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _noted.add(folder)
