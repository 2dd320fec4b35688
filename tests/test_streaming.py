from __future__ import annotations

import json
import os

import pytest
from conftest import DAY, NOON, NOWHERE, PATAGONIA, RIOHACHA

from heliovane.operators.dedup import dedup_observations
from heliovane.operators.gold import build_gold
from heliovane.operators.silver import enrich, flatten_feed
from heliovane.plans import jobs
from heliovane.sources.bronze import read_feed
from heliovane.sources.lake import read_silver
from heliovane.streaming.days import read_rejected, timed_readings, write_days_stream
from heliovane.streaming.feed import (
    read_feed_stream,
    stream_daily,
    stream_silver,
    write_daily_stream,
    write_silver_stream,
)


def reading(dt, place=PATAGONIA, **current):
    values = {"dt": dt, "uvi": 1.0, "temp": 10.0, "pressure": 1000, "wind_speed": 2.0} | current
    return {"_airbyte_data": {"lat": place[0], "lon": place[1], "current": values}}


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()

    def deliver(name, *readings):
        (folder / f"{name}.json").write_text("".join(json.dumps(r) + "\n" for r in readings))
        return str(folder)

    return deliver


def run_silver(spark, path, root, **options):
    silver = stream_silver(read_feed_stream(spark, path, **options))
    query = write_silver_stream(silver, str(root / "table"), str(root / "state"))
    query.awaitTermination()
    return query


def stored(spark, root):
    return read_silver(spark, str(root / "table"))


def test_every_delivery_is_appended_once_and_read_once(spark, feed, tmp_path):
    path = feed("a", *[reading(NOON)] * 50, reading(NOON, RIOHACHA), reading(NOON, NOWHERE))
    assert run_silver(spark, path, tmp_path).lastProgress["numInputRows"] == 52
    feed("b", reading(NOON), reading(NOON + 3600), reading(None), reading(NOON, (None, 1.0)), reading(2**62))
    assert run_silver(spark, path, tmp_path).lastProgress["numInputRows"] == 5
    batch = enrich(flatten_feed(read_feed(spark, path)))
    streamed = stored(spark, tmp_path)
    assert streamed.count() == batch.count() == 57
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_late_readings_and_bad_times_lose_nothing(spark, feed, tmp_path):
    path = feed("a", reading(NOON + 10 * DAY), reading((NOON + 5) * 1000))
    for name, first in (("b", NOON), ("c", NOON - 100 * DAY)):
        feed(name, *[reading(first + 3600 * h) for h in range(24)], reading(first))
    silver, state = str(tmp_path / "table"), str(tmp_path / "state")
    assert jobs.run_feed(spark, path, silver, state, files_per_batch=1) == 52
    assert jobs.run_feed(spark, path, silver, state) == 52
    kept = dedup_observations(read_silver(spark, silver).selectExpr("*", "0 AS source_rank"))
    assert kept.count() == 50
    gold = str(tmp_path / "gold")
    assert jobs.run_gold(spark, silver, gold, dedup=True) == 50
    feed("d", reading(NOON), reading(NOON + 60))
    jobs.run_feed(spark, path, silver, state)
    jobs.run_gold(spark, silver, gold, [(2024, 1)], dedup=True)
    assert spark.read.parquet(gold).count() == 51


def test_one_file_per_batch_gives_the_same_table(spark, feed, tmp_path):
    for i in range(4):
        path = feed(str(i), reading(NOON + i * 600), reading(NOON + 600))
    run_silver(spark, path, tmp_path, max_files_per_trigger=1)
    times = sorted(r.dt - NOON for r in stored(spark, tmp_path).collect())
    assert times == [0, 600, 600, 600, 600, 600, 1200, 1800]


def test_daily_windows_are_utc_days_and_update(spark, feed, tmp_path, conf):
    conf("spark.sql.session.timeZone", "America/Bogota")
    midnight = NOON - DAY // 2
    path = feed("a", reading(midnight, uvi=1.0), reading(midnight + DAY - 1, uvi=3.0),
                reading(midnight + DAY, uvi=5.0), reading(NOON, NOWHERE), reading(None))

    def run():
        daily = stream_daily(read_feed_stream(spark, path))
        root = tmp_path / "daily"
        write_daily_stream(daily, str(root / "table"), str(root / "state")).awaitTermination()
        rows = spark.read.parquet(str(root / "table")).orderBy("day").collect()
        return [(r.region, r.year, r.month, r.day, r.observations, r.solar_mean) for r in rows]

    assert run() == [("Patagonia", 2024, 1, 1, 2, 27.0), ("Patagonia", 2024, 1, 2, 1, 67.5)]
    feed("b", reading(midnight + DAY + 60, uvi=7.0))
    assert run()[1] == ("Patagonia", 2024, 1, 2, 2, 81.0)


def test_finished_days_are_appended_once(spark, feed, tmp_path):
    table, state = str(tmp_path / "t"), str(tmp_path / "s")

    def days():
        daily = stream_daily(read_feed_stream(spark, path))
        write_daily_stream(daily, table, state, finished_only=True).awaitTermination()
        rows = spark.read.schema("day int, observations long").parquet(table)
        return sorted((r.day, r.observations) for r in rows.collect())

    path = feed("a", reading(NOON), reading(NOON + 60))
    assert days() == []
    feed("b", reading(NOON + DAY), reading(NOON + 120))
    assert days() == [(1, 3)]
    feed("c", reading(NOON + 180), reading(NOON + 2 * DAY))
    assert days() == [(1, 3), (2, 1)]


def test_stream_and_batch_share_the_power_model(spark, feed, tmp_path):
    path = feed("a", reading(NOON, temp=31, uvi=3.2, pressure=1010, wind_speed=7.1))
    daily = stream_daily(read_feed_stream(spark, path))
    write_daily_stream(daily, str(tmp_path / "t"), str(tmp_path / "s")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "t")).first()
    batch = build_gold(enrich(flatten_feed(read_feed(spark, path)))).first()
    assert streamed.total_mean == batch.potencial_renovable_total_w


BAD_TIME = (NOON + 5) * 1000


def run_days(spark, path, root, name, **options):
    """The table's days, and the readings rejected so far."""
    paths = [str(root / f"{name}-{part}") for part in ("days", "rejected", "state")]
    rejected = jobs.run_days(spark, path, *paths, **options)
    table = read_if_any(spark, paths[0], "region string, day int, month int, observations long, solar_mean double")
    days = sorted((r.region, r.month, r.day, r.observations) for r in table.collect())
    found = sorted((r.dt or 0, r.reason) for r in read_rejected(spark, paths[1]).collect())
    assert rejected == len(found)
    return days, found


def read_if_any(spark, path, schema):
    return spark.read.schema(schema).parquet(path) if os.path.isdir(path) else spark.createDataFrame([], schema)


def test_one_bad_time_closes_no_day(spark, feed, tmp_path):
    """A reading in milliseconds once moved the watermark so far that nothing came out any more."""
    midnight = NOON - DAY // 2
    path = feed("a", *[reading(midnight + 3600 * h) for h in range(24)], reading(BAD_TIME), reading(None))
    running = run_days(spark, path, tmp_path, "all", files_per_batch=1)
    finished = run_days(spark, path, tmp_path, "done", files_per_batch=1, finished_only=True)
    bad = [(0, "no time"), (BAD_TIME, "ahead of its delivery")]
    assert running == ([("Patagonia", 1, 1, 24)], bad)
    assert finished == ([], bad)
    feed("b", *[reading(midnight + DAY + 3600 * h) for h in range(24)], reading(midnight + 5), reading(2**62))
    bad.append((2**62, "no time"))
    assert run_days(spark, path, tmp_path, "all") == ([("Patagonia", 1, 1, 25), ("Patagonia", 1, 2, 24)], sorted(bad))
    assert run_days(spark, path, tmp_path, "done", finished_only=True) == ([("Patagonia", 1, 1, 25)], sorted(bad))
    feed("c", reading(midnight + 2 * DAY), reading(midnight + 6), reading(NOON - 100 * DAY), reading(midnight + DAY + 7))
    assert run_days(spark, path, tmp_path, "all")[1] == sorted(bad)
    late = "after its day was closed"
    bad += [(midnight + 6, late), (NOON - 100 * DAY, late)]
    assert run_days(spark, path, tmp_path, "done", finished_only=True) == ([("Patagonia", 1, 1, 25)], sorted(bad))
    feed("d", reading(midnight + 2 * DAY + 7200, RIOHACHA))
    days = [("Patagonia", 1, 1, 25), ("Patagonia", 1, 2, 25)]
    assert run_days(spark, path, tmp_path, "done", finished_only=True) == (days, sorted(bad))


def test_a_time_is_measured_by_the_file_that_delivers_it(spark, feed, tmp_path):
    path = feed("a", reading(NOON), reading(NOON + 3500), reading(NOON + 3700), reading(NOON, NOWHERE), reading(BAD_TIME, NOWHERE))
    os.utime(f"{path}/a.json", (NOON, NOON))
    days = run_days(spark, path, tmp_path, "x")
    assert days == ([("Patagonia", 1, 1, 2)], [(NOON + 3700, "ahead of its delivery")])


def test_a_batch_that_runs_again_changes_nothing(spark, feed, tmp_path):
    """The work of a batch done, but not noted in the stream's log: as after a crash."""
    midnight = NOON - DAY // 2
    options = {"files_per_batch": 1, "finished_only": True}
    for k in range(4):
        path = feed(str(k), reading(midnight + k * DAY), reading(midnight + k * DAY + 60), reading(midnight + (k - 3) * DAY), reading(None))
        os.utime(f"{path}/{k}.json", (NOON + 10 * DAY + k, NOON + 10 * DAY + k))
        before = run_days(spark, path, tmp_path, "x", **options)
    commits = sorted((tmp_path / "x-state" / "stream" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    assert len(commits) == 4
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert run_days(spark, path, tmp_path, "x", **options) == before
    assert [reason for _, reason in before[1]].count("after its day was closed") == 3
    assert len(os.listdir(tmp_path / "x-state" / "days")) == 2


def test_days_of_one_run_and_of_many_are_the_same(spark, feed, tmp_path):
    for k in range(5):
        path = feed(str(k), *[reading(NOON + k * DAY + 600 * i, uvi=i / 2) for i in range(k, 9)])
        os.utime(f"{path}/{k}.json", (NOON + 20 * DAY + k, NOON + 20 * DAY + k))
    once = run_days(spark, path, tmp_path, "once")
    assert once == run_days(spark, path, tmp_path, "many", files_per_batch=1)
    closed = run_days(spark, path, tmp_path, "closed", files_per_batch=1, finished_only=True)
    assert closed == (once[0][:-1], []) and once[1] == []


def test_repeated_deliveries_are_left_out(spark, feed, tmp_path):
    table, state = str(tmp_path / "t"), str(tmp_path / "s")

    def run(**options):
        jobs.run_feed(spark, path, table, state, repeats_within="2 days", **options)
        return sorted((r.dt or 0, r.temp) for r in read_silver(spark, table).collect())

    path = feed("a", reading(NOON), reading(NOON), reading(NOON, temp=11.0), reading(None), reading(None))
    first = [(0, 10.0), (0, 10.0), (NOON, 10.0), (NOON, 11.0)]
    assert run() == first
    # Repeats in a later run, old readings, times far ahead, and other places of the same time.
    feed("b", reading(NOON), reading(BAD_TIME), reading(NOON - 500 * DAY), reading(NOON, (None, 1.0)), reading(NOON, (None, 1.0)))
    second = sorted([*first, (BAD_TIME, 10.0), (NOON - 500 * DAY, 10.0), (NOON, 10.0), (NOON, 10.0)])
    assert run() == second
    feed("c", reading(NOON - 500 * DAY), reading(BAD_TIME), reading(NOON - 400 * DAY))
    assert run(files_per_batch=1) == sorted([*second, (NOON - 400 * DAY, 10.0)])


def test_a_repeat_after_the_time_named_is_kept(spark, feed, tmp_path):
    table, state = str(tmp_path / "t"), str(tmp_path / "s")
    for name in "abc":
        path = feed(name, reading(NOON))
        jobs.run_feed(spark, path, table, state, repeats_within="1 microsecond")
    assert read_silver(spark, table).count() >= 2
