"""The hourly feed as a stream: the same flattening and enrichment as in batch.

The silver stream appends every reading, late or without a usable time, and holds no state unless repeated deliveries
are to go at once; repeats are removed exactly when a month is refreshed. Only daily averages have event time.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from heliovane.config import PARTITION_COLUMNS, REGIONS, UNKNOWN_REGION, Region
from heliovane.functions.clock import instant, utc_date
from heliovane.operators.dedup import IDENTITY
from heliovane.operators.gold import build_gold
from heliovane.operators.silver import enrich, feed_fields, flatten_feed
from heliovane.schemas import FEED_BRONZE, OBSERVATION

# How late a reading may arrive and still be added to a day's average.
LATENESS = "2 hours"

# How far a reading's time may be ahead of the moment its file was written, as clocks differ.
AHEAD = "1 hour"

# When the file that delivers a reading was written.
ARRIVED = "_arrived"


def read_feed_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Records of the feed as they arrive, each with the time of its delivery in ``ARRIVED``."""
    reader = spark.readStream.schema(FEED_BRONZE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path).select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))


def with_event_time(silver: DataFrame) -> DataFrame:
    return silver.withColumn("_seen", instant(F.col("dt")))


def believable(ahead: str = AHEAD) -> Column:
    """Whether a reading has a time, and one not ahead of its delivery. Only such times may move a watermark."""
    return F.coalesce(F.col("_seen") <= F.col(ARRIVED) + F.expr(f"INTERVAL {ahead}"), F.lit(False))


def stream_silver(
    raw: DataFrame, regions: tuple[Region, ...] = REGIONS, repeats_within: str | None = None
) -> DataFrame:
    """Silver rows of the feed, one for each reading delivered, as a batch run gives them.

    With ``repeats_within`` (``"2 days"``) a reading that repeats one read at most that long ago, in all its values, is left
    out. Readings without a time or a place are all kept, as in batch, and so are different readings of one point
    and time. The clock is that of the runs, not of the readings, so none is ever too late to be kept. State is one row per
    reading of that time.
    """
    observations = flatten_feed(raw)
    if repeats_within is not None:
        observations = _without_repeats(observations, repeats_within)
    return enrich(observations, regions)


def _without_repeats(observations: DataFrame, within: str) -> DataFrame:
    # The time of a batch is noted in the stream's log: one that is run again has the same.
    clock = observations.withColumn("_run", F.current_timestamp()).withWatermark("_run", within)
    unidentified = reduce(or_, [F.col(key).isNull() for key in IDENTITY])
    alone = clock.withColumn("_alone", F.when(unidentified, F.expr("uuid()")))
    return alone.dropDuplicatesWithinWatermark([*OBSERVATION.names, "_alone"]).drop("_run", "_alone")


def write_silver_stream(silver: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to the silver layout, then stop.

    ``path`` must be the stream's own: Spark reads a directory that a stream writes through the stream's
    log, and would not see files that a batch job put there.
    """
    return (
        silver.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .partitionBy(*PARTITION_COLUMNS)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_daily(
    raw: DataFrame, regions: tuple[Region, ...] = REGIONS, lateness: str = LATENESS
) -> DataFrame:
    """Tumbling one-day averages of the power columns per known region. Repeats are kept, as in gold.

    State is one row per region and day; in append mode a day leaves it ``lateness`` after its end. Readings without a usable
    time, with one ahead of their delivery, or for a day that has left the state are in no average and are
    not reported; ``days.py`` reports them.
    """
    fields = [column.alias(name) for name, column in feed_fields().items()]
    gold = build_gold(with_event_time(enrich(raw.select(*fields, ARRIVED), regions)))
    date = utc_date(F.col("window.start").cast("bigint"))
    return (
        gold.where(believable() & (F.col("region") != UNKNOWN_REGION))
        .withWatermark("_seen", lateness)
        .groupBy(F.window("_seen", "1 day"), "region")
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.avg("potencia_solar_w").alias("solar_mean"),
            F.avg("potencial_eolico_w").alias("wind_mean"),
            F.avg("potencial_renovable_total_w").alias("total_mean"),
        )
        .select(
            "region",
            F.year(date).alias("year"),
            F.month(date).alias("month"),
            F.dayofmonth(date).alias("day"),
            "observations",
            "solar_mean",
            "wind_mean",
            "total_mean",
        )
    )


def write_daily_stream(
    daily: DataFrame, path: str, checkpoint: str, finished_only: bool = False
) -> StreamingQuery:
    """Store the averages of everything that has arrived, then stop.

    By default ``path`` is rewritten with the current value of every day seen, unfinished ones included;
    a replayed batch rewrites the same rows, one per region and day. ``finished_only`` appends each day
    once, when no reading can change it any more.
    """

    def replace(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = daily.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if finished_only:
        return writer.format("parquet").option("path", path).outputMode("append").start()
    return writer.foreachBatch(replace).outputMode("complete").start()
