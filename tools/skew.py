"""The jobs over skewed input: ``python tools/skew.py [copies] [sf]``.

The historical feed of the given scale (0.1) and as many copies of one of its observations as asked for (a third of 35 million by
default are reached with 11,700,000), so that one region, month and time holds most rows. Prints seconds per step.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from bench import evaluate  # noqa: E402
from fixtures import feed_bronze, history_bronze  # noqa: E402
from heliovane.operators.daily import daily_metrics  # noqa: E402
from heliovane.operators.dedup import dedup_observations, label_sources  # noqa: E402
from heliovane.operators.silver import enrich, flatten_feed, flatten_history, unify  # noqa: E402
from heliovane.plans import jobs, reports  # noqa: E402
from heliovane.session import build_session  # noqa: E402
from heliovane.sources.lake import read_gold, write_partitioned  # noqa: E402
from heliovane.sources.scratch import scratch_dir  # noqa: E402


def main() -> int:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 11_700_000
    sf_dir = f"/root/testdata/sf{sys.argv[2] if len(sys.argv) > 2 else '0.1'}"
    spark = build_session(
        "skew", "local[8]", spark__driver__memory="8g",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    history = flatten_history(history_bronze(spark, sf_dir))
    times_over = max(1, 2 * copies // max(1, history.count()))
    later = F.explode(F.sequence(F.lit(0), F.lit(times_over - 1)))
    spread = history.withColumn("n", later).withColumn("dt", F.col("dt") + F.col("n") * 86_400).drop("n")
    one = history.where("lat IS NOT NULL AND dt IS NOT NULL").orderBy("dt", "lat", "temp").first()
    values = [F.lit(one[f.name]).cast(f.dataType).alias(f.name) for f in history.schema.fields]
    hot = spark.range(copies).select(*values)
    root = scratch_dir(spark, "skew")
    rows = unify(spread, hot)
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    feed = flatten_feed(feed_bronze(spark, sf_dir))
    steps = {
        "silver": lambda: write_partitioned(enrich(rows), f"{root}/silver"),
        "gold": lambda: jobs.run_gold(spark, f"{root}/silver", f"{root}/gold"),
        "rollup": lambda: jobs.run_daily(spark, f"{root}/gold", f"{root}/daily"),
        "solar daily": lambda: evaluate(reports.solar_daily(daily_metrics(read_gold(spark, f"{root}/gold")))),
        "dedup": lambda: evaluate(dedup_observations(label_sources(rows, feed))),
    }
    times = {"rows": rows.count()}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        times[name] = round(time.perf_counter() - start, 2)
    print(json.dumps(times))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
