"""The bronze-to-gold work and three reports done the plain way, to compare with: ``python tools/plain.py [sf]``.

Inferred schemas, the calendar parsed from a text timestamp, a count before each write, no layout shuffle, and reports as SQL
over gold. Prints seconds per step, median of three runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from bench import evaluate, timed  # noqa: E402
from fixtures import landed_bronze  # noqa: E402
from heliovane.config import COORDINATE_DECIMALS, PARTITION_COLUMNS, REGIONS  # noqa: E402
from heliovane.functions.places import with_region  # noqa: E402
from heliovane.operators.gold import build_gold  # noqa: E402
from heliovane.operators.silver import FEED_PATHS, HISTORY_PATHS  # noqa: E402
from heliovane.session import build_session  # noqa: E402
from heliovane.sources.scratch import scratch_dir  # noqa: E402


def flat(raw: DataFrame, paths: dict[str, str]) -> DataFrame:
    return raw.select(*[F.col(path).alias(name) for name, path in paths.items()])


def plain_silver(spark, history_path: str, feed_path: str) -> DataFrame:
    """Types as Spark infers them, calendar fields out of a text timestamp."""
    history = flat(spark.read.option("multiLine", True).json(history_path), HISTORY_PATHS)
    points = {name: F.round(name, COORDINATE_DECIMALS) for name in ("lat", "lon")}
    both = history.withColumns(points).unionByName(flat(spark.read.json(feed_path), FEED_PATHS))
    timed_rows = both.withColumn("timestamp", F.from_unixtime("dt"))
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    dated = timed_rows.withColumns({name: part(F.to_timestamp("timestamp")) for name, part in parts.items()})
    return with_region(dated, REGIONS)


def counted_write(df: DataFrame, path: str) -> None:
    df.count()
    df.write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(path)


REPORTS = {
    "daily solar": "SELECT year, month, day, round(max(potencia_solar_w), 2) FROM gold WHERE region = 'Patagonia' "
    "GROUP BY year, month, day ORDER BY year DESC, month DESC, day DESC",
    "monthly solar": "SELECT year, month, round(avg(s), 2) FROM (SELECT year, month, day, max(potencia_solar_w) s FROM gold "
    "WHERE region = 'Patagonia' GROUP BY year, month, day) GROUP BY year, month ORDER BY year DESC, month DESC",
    "ten best days": "SELECT year, month, day, round(avg(potencial_renovable_total_w), 2) e FROM gold WHERE region = 'Patagonia' "
    "GROUP BY year, month, day ORDER BY e DESC LIMIT 10",
}


def main() -> int:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.1'}"
    spark = build_session("plain", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    bronze = landed_bronze(spark, sf_dir)
    root = scratch_dir(spark, "plain")
    silver, gold = f"{root}/silver", f"{root}/gold"
    times = {"bronze to silver": timed(lambda: counted_write(plain_silver(spark, *bronze), silver), 3)}
    times["silver to gold"] = timed(lambda: counted_write(build_gold(spark.read.parquet(silver)), gold), 3)
    spark.read.parquet(gold).createOrReplaceTempView("gold")
    for name, text in REPORTS.items():
        times[name] = timed(lambda t=text: evaluate(spark.sql(t)), 3)
    print(json.dumps(times))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
