"""What the operators share: input tables, stored intermediates, column helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliovane.sources.scratch import scratch_dir

#: Scratch files on a local file system are written without checksum files; other storage ignores these options. Where Hadoop
#: lacks its native library, it starts ``chmod`` for every file and again for its checksums.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(name: str, alias: str) -> Column:
    """An id on its way through pandas, where whole numbers beside a null become floating-point numbers."""
    return F.col(name).cast("string").alias(alias)


def as_before(df: DataFrame, name: str, kind: str) -> DataFrame:
    """``df`` with an id that was text in its own type again."""
    return df.withColumn(name, F.col(name).cast(kind))


_collecting: list[list[str]] = []


@contextmanager
def noted_scratch() -> Iterator[list[str]]:
    """The paths that ``stored`` writes inside the block, to be removed once their results are no longer read."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting.remove(paths)


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def same_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on ``doc_id`` and ``text_hash``, null ids included; the right side's two columns go."""
    keys = {name: f"other_{name}" for name in ("doc_id", "text_hash")}
    on = [F.col(name).eqNullSafe(F.col(other)) for name, other in keys.items()]
    return left.join(right.withColumnsRenamed(keys), on, how).drop(*keys.values())


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    It cuts the lineage: a lost executor costs a reread, not a recomputation, and what a later step
    derives from it cannot differ between attempts.
    """
    path = scratch_dir(df.sparkSession, purpose)
    for paths in _collecting:
        paths.append(path)
    df.write.options(**PLAIN_FILES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
