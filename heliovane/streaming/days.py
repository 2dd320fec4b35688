"""Daily averages of the hourly feed that bad times and late readings cannot spoil.

A reading's time is believed only if it is not ahead of the file that delivers it, so one time in milliseconds moves no
watermark. What is not believed, and what comes after its day was closed, is written to a table of its own with the reason.

The days still open are a rollup of sums and counts, as in batch. Each micro-batch merges what it brings into the version
that the batch before it left, and writes a version of its own: a batch that is run again finds the same version and writes
the same rows, and days, rejected readings and state of a batch lie in folders named by its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from heliovane.config import REGIONS, UNKNOWN_REGION, Region
from heliovane.functions.clock import utc_date
from heliovane.operators.daily import DAY_KEYS, daily_metrics, mean_of, merge_daily
from heliovane.operators.gold import build_gold
from heliovane.operators.silver import enrich, feed_fields
from heliovane.schemas import OBSERVATION
from heliovane.sources.lake import path_exists, remove_path
from heliovane.streaming.feed import AHEAD, ARRIVED, LATENESS, believable, with_event_time

NO_TIME, TOO_EARLY, TOO_LATE = "no time", "ahead of its delivery", "after its day was closed"

# Versions of the state that are kept: that of the last batch, and the one it is run again from.
_VERSIONS = 2


def timed_readings(raw: DataFrame, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    """Gold rows of the feed's known regions with the time of the reading and that of its delivery."""
    fields = [column.alias(name) for name, column in feed_fields().items()]
    gold = build_gold(with_event_time(enrich(raw.select(*fields, ARRIVED), regions)))
    return gold.where(F.col("region") != UNKNOWN_REGION)


def _day_end(date: Column) -> Column:
    """The end of a UTC day in whole seconds, whatever the session's time zone."""
    return (F.unix_date(date).cast("bigint") + 1) * 86_400


def _interval_seconds(spark: SparkSession, interval: str) -> int:
    zero = "timestamp '1970-01-01 00:00:00 UTC'"
    return spark.sql(f"SELECT unix_seconds({zero} + INTERVAL {interval}) - unix_seconds({zero})").first()[0]


class _State:
    """Versions of the days and of the latest time seen, by the number of the batch that left them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def days(self, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{batch}/days")

    def before(self, batch: int) -> tuple[DataFrame | None, int | None]:
        """The rollup of the days that batches before this one have left open, and the latest second they have seen."""
        if batch == 0:
            return None, None
        latest = self.spark.read.parquet(f"{self.path}/{batch - 1}/latest").first()[0]
        return self.days(batch - 1).where("not closed").drop("closed"), latest

    def leave(self, batch: int, days: DataFrame, latest: int | None) -> None:
        # A few hundred rows: one file.
        days.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{batch}/days")
        seen = self.spark.range(1).select(F.lit(latest).cast("bigint").alias("latest"))
        seen.write.mode("overwrite").parquet(f"{self.path}/{batch}/latest")
        if batch >= _VERSIONS:
            remove_path(self.spark, f"{self.path}/{batch - _VERSIONS}")


def _averages(rollup: DataFrame) -> DataFrame:
    means = [mean_of(name).alias(f"{name}_mean") for name in ("solar", "wind", "total")]
    return rollup.select(*DAY_KEYS, "observations", *means)


REJECTED = StructType(
    [
        *OBSERVATION.fields,
        StructField("region", StringType()),
        StructField(ARRIVED, TimestampType()),
        StructField("reason", StringType()),
    ]
)


def _taken(readings: DataFrame, batch: int, rejected_path: str, reason: Column) -> DataFrame:
    """The readings without a reason against them; the others are written away."""
    readings = readings.withColumn("reason", reason)
    rejected = readings.where("reason IS NOT NULL")
    if not rejected.isEmpty():
        rejected.select(REJECTED.names).write.mode("overwrite").parquet(
            f"{rejected_path}/batch={batch}"
        )
    return readings.where("reason IS NULL")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The readings that went into no average, with the reason; none if no batch had any."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], REJECTED)
    return spark.read.schema(REJECTED).parquet(path)


def write_days_stream(
    readings: DataFrame,
    path: str,
    rejected_path: str,
    state_path: str,
    finished_only: bool = False,
    lateness: str = LATENESS,
    ahead: str = AHEAD,
) -> StreamingQuery:
    """Store the daily averages of everything that has arrived, and the readings that are in none, then stop.

    ``readings`` comes from ``timed_readings``. By default ``path`` is rewritten with every day seen, and no reading is too
    late. With ``finished_only`` a day is appended once, when the latest time seen by the end of a batch is ``lateness``
    after the day's end; what comes for it later is rejected. A reading without a usable time is always rejected, and so is
    one more than ``ahead`` of the moment its file was written. State is one row per region and open day.
    """
    spark = readings.sparkSession
    allowed = _interval_seconds(spark, lateness)
    state = _State(spark, f"{state_path}/days")

    def add(batch: DataFrame, number: int) -> None:
        opened, latest = state.before(number)
        reason = F.when(F.col("_seen").isNull(), NO_TIME).when(~believable(ahead), TOO_EARLY)
        if finished_only and latest is not None:
            reason = reason.when(_day_end(utc_date(F.col("dt"))) + allowed <= latest, TOO_LATE)
        taken = _taken(batch, number, rejected_path, reason)
        newest = taken.agg(F.max("dt")).first()[0]
        latest = max((t for t in (latest, newest) if t is not None), default=None)
        rollup = daily_metrics(taken)
        rollup = rollup if opened is None else merge_daily(opened, rollup)
        closed = F.lit(False)
        if finished_only and latest is not None:
            closed = _day_end(F.make_date("year", "month", "day")) + allowed <= latest
        state.leave(number, rollup.withColumn("closed", closed), latest)
        if not finished_only:
            _averages(state.days(number)).write.mode("overwrite").parquet(path)
            return
        done = state.days(number).where("closed")
        if not done.isEmpty():
            _averages(done).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        readings.writeStream.option("checkpointLocation", f"{state_path}/stream")
        .trigger(availableNow=True)
        .foreachBatch(add)
        .start()
    )
