"""Which historical files have been read, by load."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from heliovane.sources.lake import path_exists

# Files of one load. The driver holds their names, as it does to have Spark read them.
FILES_PER_LOAD = 100_000

FILE = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
    ]
)


def _known(spark: SparkSession, manifest_path: str) -> DataFrame:
    """Files of all loads that were noted."""
    if not path_exists(spark, manifest_path):
        return spark.createDataFrame([], StructType([*FILE.fields, StructField("load", IntegerType())]))
    return spark.read.schema(FILE).parquet(manifest_path)


def new_files(spark: SparkSession, folder: str, manifest_path: str, most: int) -> tuple[int, list[Row]]:
    """The number of the next load, and at most so many files that are not in the manifest, by name.

    Only names, times and sizes are asked for; no file is opened. A file that is in the manifest with another time or size
    is an error.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(FILE.names)
    known = _known(spark, manifest_path)
    before = known.select("path", F.struct("modificationTime", "length").alias("before"))
    found = listed.join(before, "path", "left")
    changed = found.where(F.col("before").isNotNull() & (F.col("before") != F.struct("modificationTime", "length")))
    names = [row["path"] for row in changed.select("path").limit(3).collect()]
    if names:
        raise ValueError(f"files changed after they were read: {', '.join(names)} …")
    number = known.agg(F.max("load")).first()[0]
    files = found.where("before IS NULL").select(FILE.names).orderBy("path").limit(most).collect()
    return 0 if number is None else number + 1, files


def as_path(name: str) -> str:
    """A listed file as a path to read that stands for itself only."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", name)


def note_files(spark: SparkSession, manifest_path: str, number: int, files: list[Row]) -> None:
    """Note the files of a load, all at once: a list that was not finished is not read."""
    listed = spark.createDataFrame(files, FILE)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{manifest_path}/load={number}")
