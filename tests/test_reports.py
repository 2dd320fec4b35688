from __future__ import annotations

import math
import random

import pytest
from conftest import DAY, NOON, NOWHERE, PATAGONIA, RIOHACHA, plan_of
from pyspark.sql import functions as F

from heliovane.operators.daily import daily_metrics, mean_of, merge_daily, pooled_mean
from heliovane.operators.gold import build_gold
from heliovane.plans import reports
from heliovane.sources.lake import read_gold, write_partitioned

GOLD = "dt long, region string, year int, month int, day int, temp double, pressure int, " \
    "humidity int, wind_speed double, uvi double, potencia_solar_w double, " \
    "potencial_eolico_w double, potencial_renovable_total_w double"


@pytest.fixture
def gold(spark):
    """Gold rows out of ``(region, (year, month, day), solar, wind, total)``."""

    def build(*rows):
        full = [
            (1, region, *date, 20.0, 1000, 50, 2.0, 1.0, solar, wind, total)
            for region, date, solar, wind, total in rows
        ]
        return spark.createDataFrame(full, GOLD)

    return build


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_solar_daily(gold):
    rows = gold(
        ("Patagonia", (2024, 1, 2), 1.004, 0.0, 0.0),
        ("Patagonia", (2024, 1, 2), 3.996, 0.0, 0.0),
        ("Riohacha", (2024, 1, 2), None, 0.0, 0.0),
        ("Riohacha", (2024, 1, 3), 7.0, 0.0, 0.0),
        ("No Region", (2023, 12, 31), 9.0, 0.0, 0.0),
        ("Patagonia", (None, None, None), 5.0, 0.0, 0.0),
    )
    report = reports.solar_daily(daily_metrics(rows))
    assert report.columns == [
        "year", "month", "day", "var_pot_solar_patagonia", "var_pot_solar_riohacha"
    ]
    assert tuples(report) == [
        (2024, 1, 3, None, 7.0),
        (2024, 1, 2, 4.0, None),
        (2023, 12, 31, None, None),
        (None, None, None, 5.0, None),
    ]


def test_wind_daily_is_a_spread_of_rounded_ends(gold):
    rows = gold(
        ("Patagonia", (2024, 1, 2), 0.0, 10.006, 0.0),
        ("Patagonia", (2024, 1, 2), 0.0, 5.004, 0.0),
        ("Riohacha", (2024, 1, 2), 0.0, 4.0, 0.0),
    )
    assert tuples(reports.wind_daily(daily_metrics(rows))) == [(2024, 1, 2, 5.01, 0.0)]


@pytest.mark.parametrize("report, position", [("solar_monthly", 2), ("wind_monthly", 3)])
def test_monthly_reports_compare_daily_means(gold, report, position):
    def row(region, date, value):
        line = [region, date, 0.0, 0.0, 0.0]
        line[position] = value
        return tuple(line)

    rows = gold(
        row("Patagonia", (2024, 1, 1), 9.0),
        row("Patagonia", (2024, 1, 1), 11.012),
        row("Patagonia", (2024, 1, 2), 5.004),
        row("Patagonia", (2024, 1, 3), None),
        row("Riohacha", (2024, 1, 3), 2.0),
        row("No Region", (2024, 2, 3), 100.0),
    )
    got = tuples(getattr(reports, report)(daily_metrics(rows)))
    assert got == [(2024, 2, None, None), (2024, 1, 5.01, 0.0)]


def test_extreme_days_order_nulls_and_ties(gold):
    days = [("Patagonia", (2024, 1, d), 0.0, 0.0, 50.0) for d in range(1, 10)]
    days += [("Patagonia", (2024, 2, d), 0.0, 0.0, 10.001 * d) for d in (1, 9)]
    days += [("Patagonia", (2024, 3, 1), 0.0, 0.0, None), ("Riohacha", (2024, 1, 1), 0.0, 0.0, 1e6)]
    daily = daily_metrics(gold(*reversed(days)))

    best = tuples(reports.extreme_days(daily, "Patagonia", best=True))
    assert [r[2:] for r in best] == [(2, 9, 90.01)] + [(1, d, 50.0) for d in range(1, 10)]
    worst = tuples(reports.extreme_days(daily, "Patagonia", best=False))
    assert [r[2:] for r in worst] == [(2, 1, 10.0)] + [(1, d, 50.0) for d in range(1, 10)]
    every = tuples(reports.extreme_days(daily, "Patagonia", best=False, limit=99))
    assert every[-1] == ("Patagonia", 2024, 3, 1, None)


def test_all_extremes_agree_with_the_single_reports(gold):
    days = [
        (region, (2024, m, d), 0.0, 0.0, float((m * 31 + d) * k % 17))
        for region, k in (("Patagonia", 7), ("Riohacha", 5), ("No Region", 3))
        for m in (1, 2)
        for d in range(1, 20)
    ]
    daily = daily_metrics(gold(*days))
    together = reports.extreme_days_all(daily).collect()
    assert {r.region for r in together} == {"Patagonia", "Riohacha"}
    for region in ("Patagonia", "Riohacha"):
        for extreme in ("max", "min"):
            single = tuples(reports.extreme_days(daily, region, extreme == "max"))
            picked = [tuple(r)[:5] for r in together if (r.region, r.extreme) == (region, extreme)]
            assert picked == single


def test_reports_do_not_depend_on_partitions_or_order(spark, silver):
    rows = build_gold(
        silver(
            *[
                (NOON + i * 3600, (PATAGONIA, RIOHACHA, NOWHERE)[i % 3], i * 7 % 121 / 10,
                 i * 13 % 500 / 10 - 10, 980 + i % 60, i * 11 % 250 / 10)
                for i in range(600)
            ]
        )
    ).cache()
    shapes = [rows.coalesce(1), rows.repartition(7), rows.orderBy(F.rand(3))]
    for report in (reports.solar_daily, reports.wind_daily, reports.solar_monthly,
                   reports.wind_monthly, reports.extreme_days_all):
        results = [tuples(report(daily_metrics(s))) for s in shapes]
        assert results[0] == results[1] == results[2]
        assert results[0]
    rows.unpersist()


def test_merged_rollups_equal_one_rollup(gold):
    first = gold(("Patagonia", (2024, 1, 1), 1.0, 2.0, 3.0), ("Riohacha", (2024, 1, 1), 4.0, None, None))
    second = gold(("Patagonia", (2024, 1, 1), 5.0, 8.0, 13.0), ("Patagonia", (2024, 1, 2), 1.0, 1.0, 2.0))
    merged = merge_daily(daily_metrics(first), daily_metrics(second))
    whole = daily_metrics(first.unionByName(second))
    assert merged.columns == whole.columns
    assert merged.exceptAll(whole).count() == 0 and merged.count() == whole.count()


# --- Plans -------------------------------------------------------------------------------------


@pytest.fixture
def stored(spark, silver, tmp_path):
    path = str(tmp_path / "gold")
    rows = silver(
        *[(NOON + i * DAY, (PATAGONIA, RIOHACHA)[i % 2], 1.0, 10.0, 1000, 2.0) for i in range(90)]
    )
    write_partitioned(build_gold(rows), path)
    return read_gold(spark, path)


def read_schema(plan: str) -> str:
    return next(line for line in plan.splitlines() if line.startswith("ReadSchema"))


def test_extreme_days_prune_partitions_columns_and_sorting(stored):
    plan = plan_of(reports.extreme_days(daily_metrics(stored), "Patagonia"))
    assert "PartitionFilters: [isnotnull(region" in plan and "= Patagonia)]" in plan
    assert "TakeOrderedAndProject" in plan
    assert "Sort\n" not in plan and "Sort [" not in plan
    assert read_schema(plan) == "ReadSchema: struct<day:int,potencial_renovable_total_w:double>"


@pytest.mark.parametrize(
    "report, column",
    [
        (reports.solar_daily, "potencia_solar_w"),
        (reports.solar_monthly, "potencia_solar_w"),
        (reports.wind_daily, "potencial_eolico_w"),
        (reports.wind_monthly, "potencial_eolico_w"),
    ],
)
def test_reports_read_two_columns_and_aggregate_before_shuffling(stored, report, column):
    plan = plan_of(report(daily_metrics(stored)))
    assert read_schema(plan) == f"ReadSchema: struct<day:int,{column}:double>"
    # By region-day, by report group, and for the final order: only the first carries more than days.
    assert plan.count("- Exchange (") == 3
    assert "partial_" in plan and "Join" not in plan


def unguarded(df) -> list:
    """The means behind the reports to the last bit, by day and pooled by month."""
    days = df.select("region", "day", *[mean_of(p).alias(p) for p in ("solar", "wind", "total", "temp", "pressure")])
    months = df.groupBy("region", "month").agg(pooled_mean("solar").alias("solar"), pooled_mean("total").alias("total"))
    return sorted(map(repr, [*days.collect(), *months.collect()]))


def test_means_do_not_depend_on_partitions_or_merges(spark, gold):
    rng = random.Random(4)
    rows = [
        (rng.choice(["A", "B"]), (2024, 1, rng.randrange(1, 4)), *[rng.uniform(0, 4_000) / 3 ** rng.randrange(20) for _ in range(3)])
        for _ in range(5_000)
    ]
    table = gold(*rows)
    one = unguarded(daily_metrics(table.coalesce(1)))
    for count in (7, 200):
        assert unguarded(daily_metrics(table.repartition(count))) == one
    part = F.pmod(F.xxhash64("potencia_solar_w"), F.lit(3))
    loads = [daily_metrics(table.where(part == k).repartition(5)) for k in range(3)]
    assert unguarded(merge_daily(*loads)) == unguarded(merge_daily(merge_daily(*loads[::-1][:2]), loads[0])) == one
    for r in daily_metrics(table).select("region", "day", mean_of("wind").alias("wind")).collect():
        own = [x[3] for x in rows if x[0] == r.region and x[1][2] == r.day]
        assert r.wind == pytest.approx(math.fsum(own) / len(own), rel=0, abs=2**-40)


@pytest.mark.parametrize("values,mean", [
    ([-5.5, 2.25], -1.625), ([0.1] * 10, 0.1), ([1e300, 1.0, -1e300], 1 / 3), ([None, None], None), ([3.0, None], 3.0),
    ([2.0**22, -(2.0**22) + 1], 0.5), ([float("nan"), 1.0], float("nan")), ([float("inf"), 1.0], float("inf")), ([-1e-13], 0.0),
])
def test_sums_of_any_numbers(gold, values, mean):
    (row,) = daily_metrics(gold(*[("A", (2024, 1, 1), v, 0.0, 0.0) for v in values])).select(mean_of("solar").alias("m")).collect()
    assert row.m == pytest.approx(mean, abs=2**-40, nan_ok=True) if mean is not None else row.m is None


def test_sums_of_a_day_do_not_overflow(spark, gold):
    """As many rows as no day has, all with the largest value: what the limbs of so many rows add up to."""
    day = daily_metrics(gold(("A", (2024, 1, 1), 2.0**22 - 1, 0.0, 0.0), ("A", (2024, 1, 1), -3.0, 0.0, 0.0)))
    for _ in range(30):
        day = spark.createDataFrame(merge_daily(day, day).collect(), day.schema)
    assert day.first().observations == 2**31
    assert day.select(mean_of("solar")).first()[0] == (2.0**22 - 4) / 2
