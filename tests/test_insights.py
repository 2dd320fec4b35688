from __future__ import annotations

import statistics

import pytest
from conftest import DAY, NOON, NOWHERE, PATAGONIA, RIOHACHA, plan_of
from pyspark.sql import functions as F

from heliovane.operators.daily import daily_metrics
from heliovane.operators.gold import build_gold
from heliovane.plans import insights


@pytest.fixture
def gold(spark, silver):
    """One row per day whose total power equals the given value: no wind, 10 degrees."""

    def build(place, totals, start=NOON):
        rows = [
            (start + day * DAY, place, total / 13.5, 10.0, 1000, 0.0)
            for day, total in totals.items()
        ]
        return build_gold(silver(*rows))

    return build


def test_low_power_days_are_those_under_the_quantile(gold):
    rows = gold(PATAGONIA, {d: float(d) for d in range(1, 21)})
    report = insights.low_power_conditions(daily_metrics(rows)).collect()
    assert [(r.region, r.low_power, r.days) for r in report] == [
        ("Patagonia", False, 18),
        ("Patagonia", True, 2),
    ]
    assert report[1].mean_total == 1.5 and report[0].mean_total == 11.5
    assert report[0].mean_pressure == 1000.0
    assert report[0].corr_uvi == report[1].corr_uvi == 1.0
    assert report[0].corr_pressure is None


def test_low_power_scans_gold_once(gold):
    plan = plan_of(insights.low_power_conditions(daily_metrics(gold(PATAGONIA, {1: 1.0}))))
    assert "Join" not in plan


def test_persistence_forecast_uses_neighbouring_days_only(gold):
    rows = gold(PATAGONIA, {1: 10.0, 2: 13.0, 3: 11.0, 7: 100.0, 8: 90.0}).unionByName(
        gold(NOWHERE, {1: 1.0, 2: 9.0})
    )
    report = insights.persistence_forecast(daily_metrics(rows)).collect()
    assert [tuple(r) for r in report] == [("Patagonia", 3, 5.0, 3.0)]
    change = insights.intermittency(daily_metrics(rows)).collect()
    assert [tuple(r) for r in change] == [("Patagonia", 3, 5.0, 10.0)]


def test_forecast_feed_against_observations(spark, gold):
    observed = gold(PATAGONIA, {1: 10.0, 2: 20.0})
    repeated = observed.unionByName(observed)
    forecasts = spark.createDataFrame(
        [("Patagonia", NOON + DAY, 12.0), ("Patagonia", NOON + 2 * DAY, 16.0),
         ("Patagonia", NOON + 9 * DAY, 1.0), ("Riohacha", NOON + DAY, 1.0)],
        "region string, dt long, forecast_total_w double",
    )
    report = insights.forecast_errors(forecasts, repeated).collect()
    assert [tuple(r) for r in report] == [("Patagonia", 2, 3.0, -1.0)]


def test_forecast_join_never_broadcasts(spark, gold):
    observed = gold(PATAGONIA, {1: 10.0})
    forecasts = observed.select("region", "dt", F.lit(1.0).alias("forecast_total_w"))
    plan = plan_of(insights.forecast_errors(forecasts, observed))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_heat_losses_push_the_filter_to_the_scan(spark, gold, tmp_path):
    gold(PATAGONIA, {1: 10.0}).write.parquet(str(tmp_path / "g"))
    plan = plan_of(insights.heat_losses(spark.read.parquet(str(tmp_path / "g"))))
    assert "GreaterThan(temp,32.0)" in plan
    assert "ReadSchema: struct<temp:double,region:string>" in plan


def test_heat_losses_on_hot_readings(silver):
    rows = silver(
        *[(NOON, RIOHACHA, 1.0, t, 1000, 1.0) for t in (20.0, 32.0, 33.0, 37.5, None)],
        (NOON, NOWHERE, 1.0, 40.0, 1000, 1.0),
    )
    report = insights.heat_losses(build_gold(rows)).collect()
    assert [tuple(r) for r in report] == [("Riohacha", 2, 0.041, 0.05)]


def test_seasonality_is_the_deviation_of_pooled_monthly_means(gold):
    january = {0: 10.0, 1: 20.0}
    rows = gold(PATAGONIA, january).unionByName(gold(PATAGONIA, {40: 40.0})).unionByName(
        gold(PATAGONIA, {40: 70.0})
    )
    row = insights.seasonality(daily_metrics(rows)).first()
    assert (row.region, row.months) == ("Patagonia", 2)
    assert row.solar_monthly_stddev == pytest.approx(statistics.stdev([15.0, 55.0]), abs=1e-6)
    assert row.wind_monthly_stddev == 0.0


def test_undated_rows_do_not_reach_day_based_insights(gold):
    rows = gold(PATAGONIA, {1: 1.0, 2: 2.0}).withColumns(
        {c: F.lit(None).cast("int") for c in ("year", "month", "day")}
    )
    daily = daily_metrics(rows)
    for insight in (insights.persistence_forecast, insights.intermittency, insights.seasonality):
        assert insight(daily).count() == 0
