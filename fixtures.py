"""Weather-shaped bronze data out of the driver's tables (``FIXTURES.md``).

``lineitem`` stands in for the historical feed, ``events`` for the hourly one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliovane.functions.clock import SECONDS_PER_DAY
from heliovane.sources.scratch import scratch_dir

# Records per historical document: about 9 MB of JSON.
DOCUMENT_RECORDS = 50_000

# Records per file of the hourly feed.
FEED_FILE_RECORDS = 20_000

# Records of the arrays that are short or in odd styles. Beyond so many files the arrays become longer instead.
SHORT_RECORDS, SHORT_FILES = 200, 2_000
STYLED_RECORDS, STYLED_FILES = 3_000, 2_000

# Arrays in a file that holds several.
ARRAYS_PER_FILE = 8

# Records per file of the unsteady feed. Beyond so many files they become larger, beyond so many batches a batch takes more.
UNSTEADY_RECORDS, UNSTEADY_FILES, UNSTEADY_BATCHES = 2_000, 1_024, 64


def _grown(records: int, rows: int, files: int, most: int | None = None) -> int:
    """Records per file: ``records``, or more if these were more than so many files, but not beyond ``most``."""
    grown = max(records, -(-rows // files))
    return grown if most is None else min(grown, most)


def _epoch_seconds(ts: str) -> Column:
    """Whole seconds of a timestamp without zone, whatever the session time zone."""
    days = F.date_diff(F.to_date(F.col(ts)), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def _readings(k: Column) -> dict[str, Column]:
    return {
        "uvi": F.when(k % 97 != 0, (k * 7 % 121) / F.lit(10.0)),
        "temp": F.when(k % 89 != 0, (k * 13 % 500) / F.lit(10.0) - F.lit(10.0)),
        "pressure": F.when(k % 83 != 0, (F.lit(980) + k * 17 % 60).cast("int")),
        "humidity": (k % 101).cast("int"),
        "wind_speed": (k * 11 % 250) / F.lit(10.0),
    }


def _by_third(k: Column, first: float, second: float) -> Column:
    return F.when(k % 3 == 0, F.lit(first)).when(k % 3 == 1, F.lit(second)).otherwise(F.lit(0.0))


def history_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested historical records."""
    return _history_rows(spark, sf_dir).drop("k")


def _history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    r = _readings(k)
    return (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
            _epoch_seconds("l_shipdate").alias("ep"),
        )
        .select(
            "k",
            (F.col("ep") + k % 24 * 3600).alias("dt"),
            _by_third(k, -41.810145, 11.538415).alias("lat"),
            _by_third(k, -68.9063, -72.91679).alias("lon"),
            r["uvi"].alias("uv_index"),
            F.struct(
                r["temp"].alias("temp"),
                r["pressure"].alias("pressure"),
                r["humidity"].alias("humidity"),
            ).alias("main"),
            F.struct(r["wind_speed"].alias("speed")).alias("wind"),
        )
    )


def feed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested hourly feed records."""
    return _feed_rows(spark, sf_dir).drop("k")


def _feed_rows(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    k = F.col("k")
    r = _readings(k)
    lat = F.when(k % 17 == 0, F.lit(-41.81012)).otherwise(_by_third(k, -41.8101, 11.5384))
    current = F.struct(
        F.when(k % 211 != 0, F.col("ep")).alias("dt"),
        *[column.alias(name) for name, column in r.items()],
    )
    envelope = F.struct(
        F.when(k % 101 != 0, lat).alias("lat"),
        _by_third(k, -68.9063, -72.9168).alias("lon"),
        current.alias("current"),
    )
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .select(F.col("event_id").alias("k"), _epoch_seconds("ts").alias("ep"))
        .select("k", *more, envelope.alias("_airbyte_data"))
    )


def dirty_history_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The historical feed as text lines: quoted numbers, decimals for whole numbers, text and numbers out of range where
    numbers belong, and lines that are not JSON."""
    k = F.col("k")
    pressure = F.when(k % 13 == 0, "1010.7").when(k % 17 == 0, "99999999999")
    main = F.struct(
        F.when(k % 11 == 0, "x").otherwise(F.col("main.temp").cast("string")).alias("temp"),
        pressure.otherwise(F.col("main.pressure").cast("string")).alias("pressure"),
        F.col("main.humidity").alias("humidity"),
    )
    dt = F.when(k % 19 == 0, "soon").otherwise(F.col("dt").cast("string")).alias("dt")
    record = F.to_json(F.struct(dt, "lat", "lon", "uv_index", main.alias("main"), "wind"))
    broken = F.concat(F.lit("not json "), k.cast("string"))
    return _history_rows(spark, sf_dir).select(F.when(k % 29 == 0, broken).otherwise(record).alias("value"))


def unsteady_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly feed, latest readings first, with times in milliseconds and with repeated deliveries."""
    k = F.col("k")
    dt = F.col("_airbyte_data.current.dt")
    dt = F.when(k % 37 == 0, dt * 1000).otherwise(dt)
    envelope = F.col("_airbyte_data").withField("current.dt", dt).alias("_airbyte_data")
    rows = _feed_rows(spark, sf_dir).select("k", envelope)
    again = rows.where(k % 5 == 0)
    latest = F.col("_airbyte_data.current.dt").desc_nulls_last()
    return rows.unionByName(again).orderBy(latest, "k").drop("k")


def land_unsteady(spark: SparkSession, sf_dir: str, path: str) -> int:
    """The unsteady feed in files; returns how many of them make a batch: one, unless there are more files than batches."""
    feed = unsteady_feed(spark, sf_dir)
    rows = feed.count()
    records = _grown(UNSTEADY_RECORDS, rows, UNSTEADY_FILES)
    land_feed(feed, path, records=records)
    return max(1, -(-rows // (records * UNSTEADY_BATCHES)))


# Deliveries of the feed that are late, repeated or have bad times, a file each.
DELIVERIES = 4
DELIVERY_DAYS = 8

# Readings in a file of a delivery. A larger feed has several files a delivery, the same number in each.
DELIVERY_RECORDS = 1_000_000


def land_deliveries(spark: SparkSession, sf_dir: str, path: str, repeats: bool = False) -> int:
    """The hourly feed in one delivery for each eight days, written in order; some readings come with the next one, some times
    are in milliseconds. With ``repeats`` some come again with the next one. Returns the files of a delivery: one, unless the
    feed is large."""
    k, ep = F.col("k"), F.col("ep")
    days = F.floor((ep - F.lit(1_704_067_200)) / SECONDS_PER_DAY / DELIVERY_DAYS)
    dt = F.col("_airbyte_data.current.dt")
    dt = F.when(k % 37 == 0, dt * 1000).otherwise(dt)
    envelope = F.col("_airbyte_data").withField("current.dt", dt).alias("_airbyte_data")
    rows = _feed_rows(spark, sf_dir, "ep").select(
        F.least(F.when(k % 11 == 0, days + 1).otherwise(days), F.lit(DELIVERIES - 1)).alias("delivery"), "k", envelope
    )
    if repeats:
        again = rows.where(k % 5 == 0)
        later = F.least(F.col("delivery") + 1, F.lit(DELIVERIES - 1)).alias("delivery")
        rows = rows.unionByName(again.select(later, "k", "_airbyte_data"))
    sizes = dict(rows.groupBy("delivery").count().collect())
    # A file needs a reading, and batches are as deliveries only if all have the same number of files.
    files = -(-max(sizes.values(), default=0) // DELIVERY_RECORDS)
    files = max(1, min([files, *[sizes.get(number, 0) for number in range(DELIVERIES)]]))
    for number in range(DELIVERIES):
        delivery = rows.where(F.col("delivery") == number).drop("delivery", "k")
        delivery = delivery.coalesce(1) if files == 1 else delivery.repartition(files)
        delivery.write.mode("append").json(path)
    return files


def land_mixed_history(history: DataFrame, path: str) -> None:
    """The historical feed in one folder as one long array, short ones, JSON Lines, and two arrays in a file."""
    part = F.pmod(F.xxhash64("dt", "lat", "uv_index", "wind"), F.lit(20))
    land_history(history.where(part < 17), f"{path}/long", records=2 * DOCUMENT_RECORDS)
    short = _grown(SHORT_RECORDS, history.count() // 20, SHORT_FILES, DOCUMENT_RECORDS)
    land_history(history.where(part == 17), f"{path}/short", records=short)
    history.where(part == 18).write.json(f"{path}/lines")
    several = _arrays(history.where(part == 19), 300).select(F.concat("value", F.lit("\n[]")))
    several.write.option("maxRecordsPerFile", ARRAYS_PER_FILE).text(f"{path}/several")


def land_styled_history(history: DataFrame, path: str) -> None:
    """The historical feed in styles that only their structure can tell apart, a folder for each."""
    style = F.pmod(F.xxhash64("dt", "lat", "uv_index", "wind"), F.lit(5))

    def of(number: int) -> DataFrame:
        return history.where(style == number)

    records = _grown(STYLED_RECORDS, history.count(), STYLED_FILES, DOCUMENT_RECORDS)
    # The first value of each record is an object that starts like a record.
    inner = F.struct(F.struct(F.lit(1).alias("temp")).alias("main"), F.col("main.*")).alias("main")
    _land(_arrays(of(0).select(inner, "dt", "lat", "lon", "uv_index", "wind"), records), f"{path}/nested")
    # Records, quotes and escapes inside a string.
    note = F.lit('a "quoted" \\ {"note":"{\\"dt\\": 5}"}, [{"note":"').alias("note")
    _land(_arrays(of(1).select(note, "*"), records), f"{path}/strings")
    # The first record of an array starts with another key than the rest.
    turned = F.to_json(F.struct(*reversed(history.columns)))
    odd = F.when(F.col("dt") % 1000 == 0, turned).otherwise(F.to_json(F.struct("*")))
    _land(_arrays(of(2), records, odd, descending=True), f"{path}/odd")
    pretty = F.to_json(F.struct("*"), {"pretty": "true"})
    _land(_arrays(of(3), records, pretty), f"{path}/indented")
    deep = _arrays(of(4), records)
    deep = deep.withColumn("value", F.concat(F.lit(" [\r\n["), "value", F.lit(",[]]]\n\n[]")))
    _land(deep, f"{path}/deep")


def _land(arrays: DataFrame, path: str) -> None:
    """A file for each array."""
    arrays.write.option("maxRecordsPerFile", 1).text(path)


def _arrays(history: DataFrame, records: int, record: Column | None = None, descending: bool = False) -> DataFrame:
    """``value``: JSON arrays of at most ``records``, each of neighbouring rows of a task, so that none is shuffled."""
    record = F.to_json(F.struct("*")) if record is None else record

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def array(texts: list[str]) -> pa.RecordBatch:
            ordered = sorted(texts, reverse=True) if descending else texts
            return pa.RecordBatch.from_arrays([pa.array([f"[{','.join(ordered)}]"])], ["value"])

        held: list[str] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= records:
                yield array(held[:records])
                held = held[records:]
        if held:
            yield array(held)

    return history.select(record.alias("record")).mapInArrow(run, "value string")


def land_history(history: DataFrame, path: str, records: int = DOCUMENT_RECORDS) -> None:
    """Write records as JSON files of one array each, none longer than ``records``."""
    _land(_arrays(history, records), path)


def land_feed(feed: DataFrame, path: str, records: int = FEED_FILE_RECORDS) -> None:
    """Write records as gzipped JSON Lines."""
    feed.write.option("compression", "gzip").option("maxRecordsPerFile", records).json(path)


_stored: dict[tuple[str, str, str], str] = {}


def _present(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException:
        return False
    return True


def stored_once(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]
) -> str:
    """Path of a derived table, written by ``write(path)`` once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored or not _present(spark, _stored[key]):
        path = scratch_dir(spark, name)
        write(path)
        _stored[key] = path
    return _stored[key]


def landed_history(spark: SparkSession, sf_dir: str) -> str:
    """Path of the historical feed as JSON files."""
    history = history_bronze(spark, sf_dir)
    return stored_once(spark, sf_dir, "history", lambda path: land_history(history, path))


def landed_feed(spark: SparkSession, sf_dir: str) -> str:
    """Path of the hourly feed as JSON files."""
    feed = feed_bronze(spark, sf_dir)
    return stored_once(spark, sf_dir, "feed", lambda path: land_feed(feed, path))


def landed_bronze(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Paths of both feeds as JSON files."""
    return landed_history(spark, sf_dir), landed_feed(spark, sf_dir)
