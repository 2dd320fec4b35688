"""Time the jobs and the reports: one JSON line on standard output.

``BENCH_SF_DIR`` names the driver's tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed
runs per query after one warm-up. Bronze JSON is landed first, untimed. Reports read the gold Parquet
table that the jobs wrote; ``rollup_*`` repeat them from the stored region-day rollup. The corpus operators
are measured by the check tool, see ``README.md``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fixtures import feed_bronze, history_bronze, landed_bronze
from heliovane.operators.daily import daily_metrics
from heliovane.operators.dedup import dedup_observations, label_sources
from heliovane.operators.quality import reject_report
from heliovane.operators.silver import enrich, flatten_feed, flatten_history
from heliovane.plans import insights, jobs
from heliovane.plans.reports import REPORTS
from heliovane.session import build_session
from heliovane.sources.bronze import read_feed, read_history
from heliovane.sources.lake import read_gold
from heliovane.sources.scratch import scratch_dir

INSIGHTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "q3_low_power_conditions": insights.low_power_conditions,
    "forecast_vs_observed": insights.persistence_forecast,
    "intermittency": insights.intermittency,
    "seasonality": insights.seasonality,
}


def evaluate(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], object], runs: int) -> float:
    action()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 4)


def measure(spark: SparkSession, sf_dir: str, runs: int) -> tuple[dict[str, float], int]:
    history_path, feed_path = landed_bronze(spark, sf_dir)
    root = scratch_dir(spark, "bench")
    silver, gold, rollup = (f"{root}/{table}" for table in ("silver", "gold", "daily"))
    times = {
        "bronze_to_silver": timed(
            lambda: jobs.run_silver(spark, history_path, feed_path, silver), runs
        ),
        "silver_to_gold": timed(lambda: jobs.run_gold(spark, silver, gold), runs),
        "gold_to_rollup": timed(lambda: jobs.run_daily(spark, gold, rollup), runs),
    }

    def from_gold() -> DataFrame:
        return daily_metrics(read_gold(spark, gold))

    times["history_array_read"] = timed(
        lambda: evaluate(flatten_history(read_history(spark, history_path))), runs
    )
    times["feed_append"] = timed(
        lambda: jobs.run_feed(
            spark, feed_path, scratch_dir(spark, "bench-live"), scratch_dir(spark, "bench-state")
        ),
        runs,
    )
    times["gold_month_refresh"] = timed(
        lambda: jobs.run_gold(spark, silver, gold, [(2024, 1)], dedup=False), runs
    )
    times["rollup_month_refresh"] = timed(
        lambda: jobs.run_daily(spark, gold, rollup, [(2024, 1)]), runs
    )
    for name, report in (REPORTS | INSIGHTS).items():
        times[name] = timed(lambda r=report: evaluate(r(from_gold())), runs)
    times["hot_day_derating"] = timed(
        lambda: evaluate(insights.heat_losses(read_gold(spark, gold))), runs
    )
    for name, report in REPORTS.items():
        times[f"rollup_{name}"] = timed(
            lambda r=report: evaluate(r(spark.read.parquet(rollup))), runs
        )

    landed = read_history(spark, history_path), read_feed(spark, feed_path)
    both = label_sources(flatten_history(landed[0]), flatten_feed(landed[1]))
    times["dedup_from_json"] = timed(lambda: evaluate(enrich(dedup_observations(both))), runs)
    history, feed = history_bronze(spark, sf_dir), feed_bronze(spark, sf_dir)
    times["dedup_silver"] = timed(
        lambda: evaluate(
            enrich(dedup_observations(label_sources(flatten_history(history), flatten_feed(feed))))
        ),
        runs,
    )
    times["reject_report"] = timed(lambda: evaluate(reject_report(history, feed)), runs)
    return times, read_gold(spark, gold).count()


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__log__level="ERROR",
    )
    times, rows = measure(spark, sf_dir, runs)
    result = {
        "metric": "jobs_reports_and_insights_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "observations": rows,
        "cpus": int(cpus),
        "runs": runs,
    }
    print(json.dumps(result))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
