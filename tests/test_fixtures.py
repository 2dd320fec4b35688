"""Landing the driver's tables as feeds: every row, in work that grows with them."""

from __future__ import annotations

import json

import __spark_entry__ as contract
import fixtures
import pytest
from conftest import plan_of
from pyspark.sql import functions as F


@pytest.fixture
def history(spark):
    k = F.col("id")
    return spark.range(0, 1_000, 1, 3).select(
        k.alias("dt"),
        F.lit(1.5).alias("lat"),
        F.lit(2.5).alias("lon"),
        (k / 10).alias("uv_index"),
        F.struct(F.lit(1.0).alias("temp"), F.lit(2).alias("pressure"), F.lit(3).alias("humidity")).alias("main"),
        F.struct(F.lit(4.0).alias("speed")).alias("wind"),
    )


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with an events table of 30 days."""
    rows = spark.range(0, 3_000, 1, 2).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr("make_dt_interval(0, id % 720)")).alias("ts"),
    )
    rows.write.parquet(str(tmp_path / "tables" / "events.parquet"))
    return str(tmp_path / "tables")


def arrays_of(path):
    return [json.loads(f.read_text()) for f in sorted(path.rglob("part-*")) if f.stat().st_size]


def test_arrays_are_not_shuffled(spark, history, tmp_path):
    assert "Exchange" not in plan_of(fixtures._arrays(history, 200))
    fixtures.land_history(history, str(tmp_path / "arrays"), records=200)
    found = arrays_of(tmp_path / "arrays")
    assert sorted(r["dt"] for a in found for r in a) == list(range(1_000))
    assert sorted(map(len, found)) == [133, 133, 134, 200, 200, 200]
    down = fixtures._arrays(history, 200, descending=True).first()[0]
    texts = [json.dumps(r) for r in json.loads(down)]
    assert texts == sorted(texts, reverse=True)


def test_files_become_larger_beyond_a_number_of_them(spark, history, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "STYLED_RECORDS", 5)
    monkeypatch.setattr(fixtures, "STYLED_FILES", 20)
    fixtures.land_styled_history(history, str(tmp_path / "styles"))
    files = [f for f in (tmp_path / "styles").rglob("part-*") if f.stat().st_size]
    assert len(files) <= 40
    monkeypatch.setattr(fixtures, "SHORT_RECORDS", 1)
    monkeypatch.setattr(fixtures, "SHORT_FILES", 5)
    fixtures.land_mixed_history(history, str(tmp_path / "mixed"))
    assert len(arrays_of(tmp_path / "mixed" / "short")) <= 10


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(contract, "SMALL_SPLIT_TASKS", 3)
    (tmp_path / "long.txt").write_text("x" * 99 + "\n" + "y" * (4 << 20))
    text = contract._with_small_splits(spark).read.text(str(tmp_path / "long.txt"))
    tasks = text.select(F.spark_partition_id().alias("task"), F.col("_metadata.file_block_start").alias("start"))
    assert text.rdd.getNumPartitions() <= 4
    assert tasks.count() == 2


def test_the_feed_is_landed_without_history(spark, tables):
    # There is no lineitem table to land.
    assert contract.bronze_stream_scan(spark, tables).count() == 3_000


def test_batches_of_the_unsteady_feed_take_more_files(spark, tables, tmp_path, monkeypatch):
    assert fixtures.land_unsteady(spark, tables, str(tmp_path / "small")) == 1
    monkeypatch.setattr(fixtures, "UNSTEADY_RECORDS", 10)
    monkeypatch.setattr(fixtures, "UNSTEADY_FILES", 90)
    monkeypatch.setattr(fixtures, "UNSTEADY_BATCHES", 30)
    assert fixtures.land_unsteady(spark, tables, str(tmp_path / "feed")) == 3
    assert len(list((tmp_path / "feed").glob("part-*"))) <= 100
    assert spark.read.json(str(tmp_path / "feed")).count() == 3_600


def test_large_deliveries_have_several_files_each(spark, tables, tmp_path, monkeypatch):
    expected = [tuple(r) for r in contract.stream_dedup(spark, tables).orderBy("dt", "uvi", "temp").collect()]
    monkeypatch.setattr(fixtures, "DELIVERY_RECORDS", 300)
    files = fixtures.land_deliveries(spark, tables, str(tmp_path / "feed"), repeats=True)
    assert files > 1 and len(list((tmp_path / "feed").glob("part-*"))) == files * fixtures.DELIVERIES
    got = [tuple(r) for r in contract.stream_dedup(spark, tables).orderBy("dt", "uvi", "temp").collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected))
