"""The eight reports, and the four best/worst-day reports in one pass.

All start from the region-day rollup (``operators.daily``), read from its table or built lazily from
gold. Every report keeps calendar groups in which none of its regions has a row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.config import REGIONS, UNKNOWN_REGION, Region
from heliovane.functions.convert import settle
from heliovane.operators.daily import mean_of, only_in

REPORT_DIGITS = 2
TOP_DAYS = 10


def _newest_first(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*[F.col(k).desc_nulls_last() for k in keys])


def _spread(highest: Column, lowest: Column) -> Column:
    """Difference of the two rounded ends, rounded again."""
    return settle(settle(highest, REPORT_DIGITS) - settle(lowest, REPORT_DIGITS), REPORT_DIGITS)


def solar_daily(daily: DataFrame, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    """Best solar reading of each day, one column per region."""
    peaks = [
        settle(F.max(only_in(r.name, F.col("solar_max"))), REPORT_DIGITS).alias(
            f"var_pot_solar_{r.slug}"
        )
        for r in regions
    ]
    return _newest_first(daily.groupBy("year", "month", "day").agg(*peaks), "year", "month", "day")


def wind_daily(daily: DataFrame, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    """Spread between each day's strongest and weakest wind reading, one column per region."""
    spreads = [
        _spread(
            F.max(only_in(r.name, F.col("wind_max"))), F.min(only_in(r.name, F.col("wind_min")))
        ).alias(f"daily_var_pot_eolico_{r.slug}")
        for r in regions
    ]
    return _newest_first(daily.groupBy("year", "month", "day").agg(*spreads), "year", "month", "day")


def _monthly_spread(daily: DataFrame, prefix: str, suffix: str, regions) -> DataFrame:
    means = daily.select("region", "year", "month", mean_of(prefix).alias("day_mean"))
    spreads = []
    for r in regions:
        in_region = only_in(r.name, F.col("day_mean"))
        spreads.append(_spread(F.max(in_region), F.min(in_region)).alias(f"{r.short}_{suffix}"))
    return _newest_first(means.groupBy("year", "month").agg(*spreads), "year", "month")


def solar_monthly(daily: DataFrame, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    """Spread of the daily mean solar power within each month."""
    return _monthly_spread(daily, "solar", "var_pot_sol_monthly", regions)


def wind_monthly(daily: DataFrame, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    """Spread of the daily mean wind power within each month."""
    return _monthly_spread(daily, "wind", "var_pot_eolico_monthly", regions)


def _rank_order(best: bool) -> list[Column]:
    """Days without a value come last either way; the earlier day wins a tie."""
    energy = F.col("avg_pot_energy_daily")
    return [
        energy.desc_nulls_last() if best else energy.asc_nulls_last(),
        *[F.col(k).asc_nulls_last() for k in ("year", "month", "day")],
    ]


def daily_energy(daily: DataFrame) -> DataFrame:
    """Mean total power per region and day, rounded as reported."""
    energy = settle(mean_of("total"), REPORT_DIGITS).alias("avg_pot_energy_daily")
    return daily.select("region", "year", "month", "day", energy)


def extreme_days(
    daily: DataFrame, region: str, best: bool = True, limit: int = TOP_DAYS
) -> DataFrame:
    """The days of one region with the most or least energy."""
    in_region = daily.where(F.col("region") == region)
    return daily_energy(in_region).orderBy(*_rank_order(best)).limit(limit)


def extreme_days_all(daily: DataFrame, limit: int = TOP_DAYS) -> DataFrame:
    """Both lists for every known region from one scan.

    The window holds one region's days, a number the calendar bounds, not its observations.
    """
    known = daily_energy(daily.where(F.col("region") != UNKNOWN_REGION))
    by_region = Window.partitionBy("region")
    ranked = known.withColumns(
        {
            "max": F.row_number().over(by_region.orderBy(*_rank_order(best=True))),
            "min": F.row_number().over(by_region.orderBy(*_rank_order(best=False))),
        }
    )
    sides = F.array(
        *[F.struct(F.lit(s).alias("extreme"), F.col(s).alias("position")) for s in ("max", "min")]
    )
    return (
        ranked.where((F.col("max") <= limit) | (F.col("min") <= limit))
        .select("region", "year", "month", "day", "avg_pot_energy_daily", F.inline(sides))
        .where(F.col("position") <= limit)
        .orderBy("region", "extreme", "position")
    )


# Report name -> function of the rollup.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "q1_solar_daily": solar_daily,
    "q1_solar_monthly": solar_monthly,
    "q2_wind_daily": wind_daily,
    "q2_wind_monthly": wind_monthly,
    **{
        f"q4_{extreme}_{r.slug}": partial(extreme_days, region=r.name, best=extreme == "max")
        for extreme in ("max", "min")
        for r in REGIONS
    },
    "q4_extremes_all": extreme_days_all,
}
