"""The partitioned Parquet tables and their catalog entry."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from heliovane.config import PARTITION_COLUMNS
from heliovane.schemas import GOLD, GOLD_TABLE, SILVER


# Bounds the rows behind one file however well they compress, so that later scans can spread them.
ROWS_PER_FILE = 2_000_000


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver by region, year and month; tables that grow by loads have one folder above these for each."""
    return spark.read.schema(SILVER).parquet(path).select(SILVER.names)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GOLD).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, overwrite: str = "static", rebalance: bool = True
) -> int:
    """Write by region, year and month; return the rows written.

    ``overwrite="static"`` replaces the whole table, ``"dynamic"`` only the partitions present in
    ``df``. ``rebalance`` shuffles rows to their partition once and lets adaptive execution merge small
    and split oversized shuffle partitions, so a month that holds a third of the table is written by
    many tasks and a quiet one as a single file. Turn it off for input that already lies by partition.

    The count is observed after that shuffle, in the tasks that write: there a retried task is counted
    once, and no second pass over the input is needed.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )
    return written.get["rows"]


def partition_files(spark: SparkSession, pattern: str) -> dict[str, frozenset[str]]:
    """Files of each existing folder that matches ``pattern``."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for folder in files.globStatus(glob) or ():
        names = [status.getPath().getName() for status in files.listStatus(folder.getPath())]
        found[folder.getPath().toString()] = frozenset(names)
    return found


def remove_unwritten(
    spark: SparkSession, pattern: str, before: dict[str, frozenset[str]]
) -> list[str]:
    """Remove the folders of ``pattern`` that a write since ``before`` was taken has left as they were.

    Dynamic overwriting replaces the partitions that still have rows; these are the ones that have none left.
    """
    stale = [f for f, names in partition_files(spark, pattern).items() if before.get(f) == names]
    for folder in stale:
        remove_path(spark, folder)
    return stale


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def remove_path(spark: SparkSession, name: str) -> None:
    """Remove a folder and what is in it, if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partition_value(value: int | None) -> str:
    """A partition column's value as it stands in a folder's name."""
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def _qualified(spark: SparkSession, path: str) -> str:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(folder).toUri().getPath()


def table_location(spark: SparkSession, name: str) -> str | None:
    """Where the files of a catalog table are, or None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def register_table(
    spark: SparkSession,
    path: str,
    name: str = "gold_weather_metrics",
    schema: StructType = GOLD_TABLE,
) -> DataFrame:
    """Publish a gold directory as an external catalog table and load its partitions.

    A name that stands for another directory is refused: its readers would not notice the change.
    """
    taken = table_location(spark, name)
    if taken is not None and _qualified(spark, taken) != _qualified(spark, path):
        raise ValueError(f"table {name} already stands for {taken}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"OPTIONS (compression 'snappy') PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) "
        f"LOCATION '{location}'"
    )
    repair_table(spark, name)
    return spark.table(name)


def partition_spec(folder: str, columns: Sequence[str] = PARTITION_COLUMNS) -> str:
    """``PARTITION (…)`` for a folder of a partitioned table, as in ``…/region=A/year=2024/month=1``."""
    values = dict(part.split("=", 1) for part in folder.rstrip("/").split("/")[-len(columns) :])

    def literal(name: str) -> str:
        value = unquote(values[name])
        if value == partition_value(None):
            return "null"
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return f"PARTITION ({', '.join(f'{name} = {literal(name)}' for name in columns)})"


def note_partitions(spark: SparkSession, name: str, written: Iterable[str], removed: Iterable[str]) -> None:
    """Tell the catalog of folders that a refresh of a table has written and removed, without listing any others."""
    for action, folders in (("ADD IF NOT EXISTS", written), ("DROP IF EXISTS", removed)):
        specs = sorted(map(partition_spec, folders))
        if specs:
            between = " " if action.startswith("ADD") else ", "
            spark.sql(f"ALTER TABLE {name} {action} {between.join(specs)}")
    # Files of partitions that were there before have changed too.
    spark.catalog.refreshTable(name)


def published_table(spark: SparkSession, name: str, path: str) -> str:
    """``name``, if it is a table of the catalog that stands for ``path``."""
    taken = table_location(spark, name)
    if taken is None:
        raise ValueError(f"there is no table {name}; publish it first")
    if _qualified(spark, taken) != _qualified(spark, path):
        raise ValueError(f"table {name} stands for {taken}")
    return name


def repair_table(spark: SparkSession, name: str) -> None:
    """Bring the catalog's partitions in line with the files: new ones in, vanished ones out."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
