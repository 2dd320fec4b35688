
from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The driver may load this file by path from anywhere.
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from fixtures import (  # noqa: E402
    dirty_history_lines,
    feed_bronze,
    history_bronze,
    land_deliveries,
    land_history,
    land_mixed_history,
    land_styled_history,
    land_unsteady,
    landed_bronze,
    landed_feed,
    landed_history,
    stored_once,
)
from heliovane.config import UNKNOWN_REGION  # noqa: E402
from heliovane.functions.clock import SECONDS_PER_DAY  # noqa: E402
from heliovane.functions.convert import settle  # noqa: E402
from heliovane.functions.power import air_density, heat_loss  # noqa: E402
from heliovane.operators.daily import (  # noqa: E402
    DAY_KEYS,
    daily_metrics,
    mean_of,
    merge_daily,
    only_in,
)
from heliovane.operators.dedup import dedup_observations, label_sources  # noqa: E402
from heliovane.operators.gold import build_gold  # noqa: E402
from heliovane.operators.quality import reject_report  # noqa: E402
from heliovane.operators.silver import (  # noqa: E402
    build_silver,
    enrich,
    flatten_feed,
    flatten_history,
    unify,
)
from heliovane.plans import insights, jobs, reports  # noqa: E402
from heliovane.schemas import OBSERVATION, POWER_COLUMNS  # noqa: E402
from heliovane.sources.bronze import read_feed, read_history  # noqa: E402
from heliovane.sources.lake import (  # noqa: E402
    read_gold,
    read_silver,
    write_partitioned,
)
from heliovane.shipping import ship_package  # noqa: E402
from heliovane.sources.published import publish_view  # noqa: E402
from heliovane.sources.scratch import scratch_dir  # noqa: E402
from heliovane.streaming import feed as streaming  # noqa: E402
from heliovane.streaming.days import read_rejected  # noqa: E402

try:
    import corpus_pipeline
    from heliovane.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    # Only the subpackage itself may be absent, not something that it needs.
    if missing.name not in ("heliovane.llm", "corpus_pipeline"):
        raise
    corpus_pipeline = corpus_queries = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"

SMALL_SPLIT_TASKS = 128


# --- Tables built lazily from the driver's parquet ---------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(history_bronze(spark, sf_dir), feed_bronze(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(_silver(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_metrics(_gold(spark, sf_dir))


def _row_level(value: Column | str) -> Column:
    """Six decimals, enough to compare engines without their last bits."""
    return settle(F.col(value) if isinstance(value, str) else value, 6, 3)


def _comparable(gold: DataFrame) -> DataFrame:
    return gold.withColumns({name: _row_level(name) for name in POWER_COLUMNS})


# --- Sources, sinks, jobs ----------------------------------------------------------------------


def bronze_hist_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_history(read_history(spark, landed_history(spark, sf_dir)))


def bronze_hist_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with splits much smaller than the files, so that every array is cut."""
    return flatten_history(read_history(_with_small_splits(spark), landed_history(spark, sf_dir)))


def _with_small_splits(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    # However many splits there are, so many tasks share them.
    session.conf.set("spark.sql.files.maxPartitionNum", str(SMALL_SPLIT_TASKS))
    return session


def bronze_hist_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in records, heads in strings, odd first records, indented and deep arrays, all of them cut."""
    path = scratch_dir(spark, "history-styles")
    land_styled_history(history_bronze(spark, sf_dir), path)
    return flatten_history(read_history(_with_small_splits(spark), path))


def bronze_hist_mixed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "history-mixed")
    land_mixed_history(history_bronze(spark, sf_dir), path)
    return flatten_history(read_history(spark, path))


def bronze_hist_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "history-lines")
    history_bronze(spark, sf_dir).write.json(path)
    return flatten_history(read_history(spark, path, "lines"))


def bronze_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_path = landed_feed(spark, sf_dir)
    return flatten_feed(read_feed(spark, feed_path))


def norm_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_history(_dirty_history(spark, sf_dir))


def _dirty_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "history-dirty")
    dirty_history_lines(spark, sf_dir).write.text(path)
    return read_history(spark, path, "lines")


def reject_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_report(_dirty_history(spark, sf_dir), feed_bronze(spark, sf_dir))


def _stored_silver(spark: SparkSession, sf_dir: str) -> str:
    bronze = landed_bronze(spark, sf_dir)
    return stored_once(spark, sf_dir, "silver", lambda path: jobs.run_silver(spark, *bronze, path))


def _stored_gold(spark: SparkSession, sf_dir: str) -> str:
    silver = _stored_silver(spark, sf_dir)
    return stored_once(spark, sf_dir, "gold", lambda path: jobs.run_gold(spark, silver, path))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _stored_silver(spark, sf_dir))


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(read_gold(spark, _stored_gold(spark, sf_dir)))


def gold_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of an older silver, then one month refreshed, and another that silver has lost: as after a full run."""
    root = scratch_dir(spark, "by-month")
    silver, gold = f"{root}/silver", f"{root}/gold"
    history = norm_hist(spark, sf_dir)
    vanished = history.where("dt % 7 = 0").withColumn("dt", F.lit(1_893_456_000).cast("bigint"))
    write_partitioned(enrich(unify(history, vanished)), silver)
    jobs.run_gold(spark, silver, gold)
    write_partitioned(_silver(spark, sf_dir), silver)
    jobs.run_gold(spark, silver, gold, [(2024, 1), (2030, 1)])
    return _comparable(read_gold(spark, gold))


def _registered_gold(spark: SparkSession, sf_dir: str) -> str:
    path = _stored_gold(spark, sf_dir)
    name = "gold_weather_metrics_" + path.rsplit("-", 1)[1]
    jobs.run_table(spark, path, name)
    return name


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(spark.table(_registered_gold(spark, sf_dir)))


def gold_table_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a month was refreshed and another went, without a repair: the refresh tells the catalog."""
    root = scratch_dir(spark, "table-by-month")
    silver, gold = f"{root}/silver", f"{root}/gold"
    history = norm_hist(spark, sf_dir)
    vanished = history.where("dt % 7 = 0").withColumn("dt", F.lit(1_893_456_000).cast("bigint"))
    write_partitioned(enrich(unify(history, vanished)), silver)
    jobs.run_gold(spark, silver, gold)
    name = "gold_by_month_" + root.rsplit("-", 1)[1]
    jobs.run_table(spark, gold, name)
    write_partitioned(_silver(spark, sf_dir), silver)
    jobs.run_gold(spark, silver, gold, [(2024, 1), (2030, 1)], table=name)
    return _comparable(spark.table(name))


def gold_view_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of gold of an older silver, with the months of the feed and one that went refreshed in one step."""
    root = scratch_dir(spark, "view-by-month")
    silver, gold = f"{root}/silver", f"{root}/gold"
    history = norm_hist(spark, sf_dir)
    vanished = history.where("dt % 7 = 0").withColumn("dt", F.lit(1_893_456_000).cast("bigint"))
    write_partitioned(enrich(unify(history, vanished)), silver)
    jobs.run_gold(spark, silver, gold)
    name = "gold_view_" + root.rsplit("-", 1)[1]
    publish_view(spark, gold, name)
    write_partitioned(_silver(spark, sf_dir), silver)
    jobs.run_gold_switched(spark, silver, f"{root}/refreshed", name, [(2024, 1), (2030, 1)])
    return _comparable(spark.table(name))


def gold_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over the catalog table, with a CTE and a derived table: which region leads, by month."""
    return spark.sql(
        f"""
        WITH days AS (
          SELECT region, year, month, day, AVG(potencial_renovable_total_w) AS energy
          FROM {_registered_gold(spark, sf_dir)} GROUP BY region, year, month, day)
        SELECT year, month,
               COUNT(CASE WHEN patagonia > riohacha THEN 1 END) AS patagonia_leads,
               COUNT(CASE WHEN riohacha > patagonia THEN 1 END) AS riohacha_leads
        FROM (SELECT * FROM days
              PIVOT (FIRST(energy) FOR region IN ('Patagonia' AS patagonia, 'Riohacha' AS riohacha)))
        GROUP BY year, month
        """
    )


def _partition_counts(spark: SparkSession, path: str) -> DataFrame:
    rows = F.count(F.lit(1)).alias("observations")
    return read_silver(spark, path).groupBy("region", "year", "month").agg(rows)


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History in three deliveries, silver brought up to date after each: as one run over all files."""
    root = scratch_dir(spark, "incremental")
    history = history_bronze(spark, sf_dir)
    part = F.pmod(F.xxhash64("dt", "lat", "uv_index", "wind"), F.lit(3))
    for number in range(3):
        land_history(history.where(part == number), f"{root}/history/{number}")
        jobs.run_history(spark, f"{root}/history", f"{root}/silver", f"{root}/manifest")
    return read_silver(spark, f"{root}/silver")


def overwrite_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of both feeds, then the feed alone: nothing of the first write is left."""
    path = scratch_dir(spark, "static")
    write_partitioned(_silver(spark, sf_dir), path)
    write_partitioned(enrich(flatten_feed(feed_bronze(spark, sf_dir))), path)
    return _partition_counts(spark, path)


def overwrite_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same second write, but other partitions stay. The feeds share none in this data."""
    path = scratch_dir(spark, "dynamic")
    write_partitioned(_silver(spark, sf_dir), path)
    write_partitioned(enrich(flatten_feed(feed_bronze(spark, sf_dir))), path, "dynamic")
    return _partition_counts(spark, path)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts observed while writing, next to the counts of the inputs."""
    history_path, feed_path = landed_bronze(spark, sf_dir)
    root = scratch_dir(spark, "counts")
    written = jobs.run_all(spark, history_path, feed_path, f"{root}/silver", f"{root}/gold")
    stored = spark.createDataFrame(list(written.items()), "stage string, rows bigint")

    def counted(stage: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("rows"))

    return (
        counted("historical", read_history(spark, history_path))
        .unionByName(counted("hourly", read_feed(spark, feed_path)))
        .unionByName(stored)
    )


def bronze_to_gold_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON to silver to gold to the stored rollup, and a report from that."""
    history_path, feed_path = landed_bronze(spark, sf_dir)
    root = scratch_dir(spark, "all")
    paths = [f"{root}/{table}" for table in ("silver", "gold", "daily")]
    jobs.run_all(spark, history_path, feed_path, *paths)
    return reports.solar_daily(spark.read.parquet(paths[-1]))


# --- Projections -------------------------------------------------------------------------------


def norm_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_history(history_bronze(spark, sf_dir))


def norm_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_feed(feed_bronze(spark, sf_dir))


def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify(norm_hist(spark, sf_dir), norm_stream(spark, sf_dir))


def calendar_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select("dt", "timestamp", "year", "month", "day")


def region_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select("dt", "lat", "lon", "region")


def solar_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir).select(
        "dt",
        "region",
        "uvi",
        "temp",
        _row_level(heat_loss(F.col("temp"))).alias("heat_loss"),
        _row_level("potencia_solar_w").alias("potencia_solar_w"),
    )


def air_density_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    density = _row_level(air_density(F.col("pressure"), F.col("temp"))).alias("air_density")
    return _silver(spark, sf_dir).select("dt", "region", "pressure", "temp", density)


def wind_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir).select(
        "dt",
        "region",
        "pressure",
        "temp",
        "wind_speed",
        _row_level("potencial_eolico_w").alias("potencial_eolico_w"),
    )


def total_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_gold(spark, sf_dir)).select("dt", "region", *POWER_COLUMNS)


# --- Aggregates --------------------------------------------------------------------------------


def _daily_means(daily: DataFrame) -> DataFrame:
    means = [_row_level(mean_of(m)).alias(f"avg_{m}") for m in ("solar", "wind", "total")]
    return daily.select(*DAY_KEYS, "observations", *means)


def daily_avg_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_means(_daily(spark, sf_dir))


def merged_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rollup per feed, merged: the same result as one rollup over both."""
    feeds = (norm_hist(spark, sf_dir), norm_stream(spark, sf_dir))
    return _daily_means(merge_daily(*[daily_metrics(build_gold(enrich(f))) for f in feeds]))


def region_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        settle(F.max(only_in(region, F.col("total_max"))), reports.REPORT_DIGITS).alias(name)
        for region, name in (("Patagonia", "patagonia"), ("Riohacha", "riohacha"))
    ]
    return _daily(spark, sf_dir).groupBy("year", "month", "day").agg(*columns)


# --- Forecasts ---------------------------------------------------------------------------------


def forecast_feed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast for each place and time: what was observed there a day before."""
    gold = _gold(spark, sf_dir)
    day_ahead = (
        gold.where((F.col("region") != UNKNOWN_REGION) & F.col("dt").isNotNull())
        .groupBy("region", (F.col("dt") + SECONDS_PER_DAY).alias("dt"))
        .agg(F.avg("potencial_renovable_total_w").alias("forecast_total_w"))
    )
    return insights.forecast_errors(day_ahead, gold)


# --- Data quality ------------------------------------------------------------------------------


def dedup_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = label_sources(norm_hist(spark, sf_dir), norm_stream(spark, sf_dir))
    return enrich(dedup_observations(both)).select(*OBSERVATION.names, "region")


def reject_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_report(history_bronze(spark, sf_dir), feed_bronze(spark, sf_dir))


# --- Streams -----------------------------------------------------------------------------------


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental job, then repeats removed as a refresh of its months does."""
    feed_path = landed_feed(spark, sf_dir)
    root = scratch_dir(spark, "stream-silver")
    jobs.run_feed(spark, feed_path, f"{root}/table", f"{root}/state")
    rows = F.count(F.lit(1)).alias("observations")
    return _without_repeats(spark, f"{root}/table").groupBy(*DAY_KEYS).agg(rows)


def _without_repeats(spark: SparkSession, path: str) -> DataFrame:
    return dedup_observations(read_silver(spark, path).withColumn("source_rank", F.lit(0)))


def stream_late_and_bad_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch per file, of a large feed per few files, later readings first, some times in milliseconds, some deliveries repeated: nothing is lost."""
    root = scratch_dir(spark, "stream-late")
    files = land_unsteady(spark, sf_dir, f"{root}/feed")
    jobs.run_feed(spark, f"{root}/feed", f"{root}/table", f"{root}/state", files_per_batch=files)
    return _without_repeats(spark, f"{root}/table").select(*OBSERVATION.names, "region")


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental job: the feed's rows as a batch run gives them."""
    feed_path = landed_feed(spark, sf_dir)
    root = scratch_dir(spark, "stream-append")
    jobs.run_feed(spark, feed_path, f"{root}/table", f"{root}/state")
    return read_silver(spark, f"{root}/table")


def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed_path = landed_feed(spark, sf_dir)
    root = scratch_dir(spark, "stream-daily")
    daily = streaming.stream_daily(streaming.read_feed_stream(spark, feed_path))
    streaming.write_daily_stream(daily, f"{root}/table", f"{root}/state").awaitTermination()
    means = ("solar_mean", "wind_mean", "total_mean")
    table = spark.read.parquet(f"{root}/table")
    return table.withColumns({name: _row_level(name) for name in means})


def stream_daily_bad_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily averages of a batch per delivery, running and of finished days only, and counts of what is in none and why."""
    root = scratch_dir(spark, "stream-bad-time")
    files = land_deliveries(spark, sf_dir, f"{root}/feed")

    def mode(name: str, finished_only: bool) -> DataFrame:
        paths = [f"{root}/{name}/{part}" for part in ("days", "rejected", "state")]
        jobs.run_days(spark, f"{root}/feed", *paths, files_per_batch=files, finished_only=finished_only)
        days = spark.read.parquet(paths[0]).drop("batch")
        means = {f"{m}_mean": _row_level(f"{m}_mean") for m in ("solar", "wind", "total")}
        rows = F.count(F.lit(1)).alias("observations")
        rejected = read_rejected(spark, paths[1]).groupBy("region", "reason").agg(rows)
        both = days.withColumns(means).unionByName(rejected, allowMissingColumns=True)
        return both.withColumn("mode", F.lit(name))

    return mode("running", False).unionByName(mode("finished", True))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch per delivery, some readings delivered again: each reading once, as batch deduplication of equal rows has it."""
    root = scratch_dir(spark, "stream-dedup")
    files = land_deliveries(spark, sf_dir, f"{root}/feed", repeats=True)
    paths = [f"{root}/feed", f"{root}/table", f"{root}/state"]
    jobs.run_feed(spark, *paths, files_per_batch=files, repeats_within="2 days")
    return read_silver(spark, paths[1]).select(*OBSERVATION.names, "region")


# --- Contract ----------------------------------------------------------------------------------


def _on_daily(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_daily(spark, sf_dir))


def _on_gold(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_gold(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    return reports.solar_daily(_daily(spark, SMOKE_DIR))


def queries() -> dict[str, Query]:
    if corpus_queries is None:
        return weather_queries()
    corpus = {**corpus_queries.queries(), "pipeline": corpus_pipeline.run}
    return {**weather_queries(), **{name: _shipped(query) for name, query in corpus.items()}}


def _shipped(query: Query) -> Query:
    """The query, after its Python workers have been given the package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def weather_queries() -> dict[str, Query]:
    return {
        "bronze_hist_scan": bronze_hist_scan,
        "bronze_hist_split_scan": bronze_hist_split_scan,
        "bronze_hist_lines_scan": bronze_hist_lines_scan,
        "bronze_hist_mixed_sizes": bronze_hist_mixed_sizes,
        "bronze_hist_styles": bronze_hist_styles,
        "bronze_stream_scan": bronze_stream_scan,
        "silver_roundtrip": silver_roundtrip,
        "silver_incremental": silver_incremental,
        "gold_roundtrip": gold_roundtrip,
        "gold_by_month": gold_by_month,
        "gold_table": gold_table,
        "gold_table_by_month": gold_table_by_month,
        "gold_view_by_month": gold_view_by_month,
        "gold_table_sql": gold_table_sql,
        "overwrite_static": overwrite_static,
        "overwrite_dynamic": overwrite_dynamic,
        "row_counts": row_counts,
        "bronze_to_gold_end_to_end": bronze_to_gold_end_to_end,
        "norm_hist": norm_hist,
        "norm_stream": norm_stream,
        "norm_dirty": norm_dirty,
        "silver_union": silver_union,
        "calendar_fields": calendar_fields,
        "region_classify": region_classify,
        "solar_power": solar_power,
        "air_density": air_density_query,
        "wind_power": wind_power,
        "total_power": total_power,
        "daily_avg_by_region": daily_avg_by_region,
        "merged_daily": merged_daily,
        "region_pivot": region_pivot,
        **{name: _on_daily(report) for name, report in reports.REPORTS.items()},
        "q3_low_power_conditions": _on_daily(insights.low_power_conditions),
        "forecast_vs_observed": _on_daily(insights.persistence_forecast),
        "forecast_feed_errors": forecast_feed_errors,
        "intermittency": _on_daily(insights.intermittency),
        "hot_day_derating": _on_gold(insights.heat_losses),
        "seasonality": _on_daily(insights.seasonality),
        "dedup_silver": dedup_silver,
        "reject_report": reject_report_query,
        "reject_report_dirty": reject_report_dirty,
        "stream_silver": stream_silver,
        "stream_late_and_bad_time": stream_late_and_bad_time,
        "stream_append": stream_append,
        "stream_daily": stream_daily,
        "stream_daily_bad_time": stream_daily_bad_time,
        "stream_dedup": stream_dedup,
    }


def oracle_sql() -> dict[str, str]:
    if corpus_queries is None:
        return oracle.oracle_sql()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**oracle.oracle_sql(), **corpus_queries.oracle_sql(), **pipeline}
