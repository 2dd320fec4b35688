"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    # Target of merged and split shuffle partitions, and so of the files a rebalanced write makes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A task that meets only a few table partitions writes them side by side instead of sorting first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Copies of one row compress to almost nothing, so bytes understate the rows of a file. A higher
    # price per file keeps a task from packing dozens of such files.
    "spark.sql.files.openCostInBytes": "32m",
}


def build_session(app: str = "heliovane", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    chosen = SETTINGS | {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
