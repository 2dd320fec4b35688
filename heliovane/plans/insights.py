"""Questions the project asks beyond the eight reports: weather behind low-power days, persistence
forecasts, heat losses, seasonality and intermittency.

All but ``heat_losses`` work on the region-day rollup. Their windows span one region's days, which the
calendar bounds, whatever the number of observations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from heliovane.config import PANEL, UNKNOWN_REGION, SolarPanel
from heliovane.functions.convert import settle
from heliovane.functions.power import heat_loss
from heliovane.operators.daily import mean_of, pooled_mean

WEATHER = ("temp", "pressure", "humidity", "speed", "uvi")

LOW_SHARE = 0.1
HOT_DAY_C = 32.0
DIGITS = 6
GUARD = 3

# Means are settled before a comparison or a threshold is taken on them.
MEAN_DIGITS = 8


def _known_days(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("region") != UNKNOWN_REGION)


def _correlation(x: str, y: str, window: WindowSpec) -> Column:
    """Pearson correlation over the rows with both values. Unlike ``corr`` under ANSI rules, a column
    that never varies gives null instead of failing the query."""
    paired = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(paired, F.col(x)), F.when(paired, F.col(y))
    scale = F.stddev_pop(a).over(window) * F.stddev_pop(b).over(window)
    return F.try_divide(F.covar_pop(a, b).over(window), scale)


def low_power_conditions(daily: DataFrame, share: float = LOW_SHARE) -> DataFrame:
    """Weather on each region's low-power days against its other days.

    A day is low when its mean total power is under the region's ``share`` quantile over days. The
    quantile comes from a window, so the observations are scanned once. ``corr_*`` relate each weather
    mean to the total over all days of the region.
    """
    region = Window.partitionBy("region")
    means = _known_days(daily).select(
        "region",
        F.round(mean_of("total"), MEAN_DIGITS).alias("total"),
        *[F.round(mean_of(w), MEAN_DIGITS).alias(w) for w in WEATHER],
    )
    judged = means.where(F.col("total").isNotNull()).withColumns(
        {
            "threshold": F.percentile("total", F.lit(share)).over(region),
            **{f"corr_{w}": _correlation(w, "total", region) for w in WEATHER},
        }
    )
    return (
        judged.withColumn("low_power", F.col("total") < F.col("threshold"))
        .groupBy("region", "low_power")
        .agg(
            F.count(F.lit(1)).alias("days"),
            *[
                settle(F.avg(c), DIGITS, GUARD).alias(f"mean_{c}")
                for c in ("total", *WEATHER)
            ],
            *[settle(F.max(f"corr_{w}"), DIGITS, GUARD).alias(f"corr_{w}") for w in WEATHER],
        )
        .orderBy("region", "low_power")
    )


def _dated_totals(daily: DataFrame) -> DataFrame:
    """``region, date, total`` with the value of the calendar day before, where there is one."""
    by_date = Window.partitionBy("region").orderBy("date")
    return (
        _known_days(daily)
        .where(F.col("year").isNotNull())
        .select(
            "region",
            F.make_date("year", "month", "day").alias("date"),
            F.round(mean_of("total"), MEAN_DIGITS).alias("total"),
        )
        .withColumns(
            {"prior_date": F.lag("date").over(by_date), "prior_total": F.lag("total").over(by_date)}
        )
        .withColumn(
            "prior_total", F.when(F.date_diff("date", "prior_date") == 1, F.col("prior_total"))
        )
        .select("region", "date", "total", "prior_total")
    )


def persistence_forecast(daily: DataFrame) -> DataFrame:
    """Error of forecasting each day's mean total power by the day before."""
    error = F.col("prior_total") - F.col("total")
    return (
        _dated_totals(daily)
        .where(error.isNotNull())
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("forecast_days"),
            settle(F.avg(F.abs(error)), DIGITS, GUARD).alias("mean_absolute_error"),
            settle(F.avg(error), DIGITS, GUARD).alias("bias"),
        )
        .orderBy("region")
    )


def forecast_errors(forecasts: DataFrame, gold: DataFrame) -> DataFrame:
    """Error of a forecast feed (``region, dt, forecast_total_w``) against observations.

    Observations are averaged per region and time before the join, so a repeated observation neither
    multiplies forecasts nor makes a hot join key. Neither side has a size bound, hence the merge join,
    which adaptive execution also splits where forecasts crowd on one key.
    """
    observed = (
        gold.where(F.col("dt").isNotNull())
        .groupBy("region", "dt")
        .agg(F.avg("potencial_renovable_total_w").alias("observed_total_w"))
    )
    error = F.col("forecast_total_w") - F.col("observed_total_w")
    return (
        forecasts.join(observed.hint("merge"), ["region", "dt"])
        .where(error.isNotNull())
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("forecasts"),
            settle(F.avg(F.abs(error)), DIGITS, GUARD).alias("mean_absolute_error"),
            settle(F.avg(error), DIGITS, GUARD).alias("bias"),
        )
    )


def heat_losses(
    gold: DataFrame, hot_day_c: float = HOT_DAY_C, panel: SolarPanel = PANEL
) -> DataFrame:
    """Mean share of solar output lost to heat on readings above ``hot_day_c``, per region."""
    loss = heat_loss(F.col("temp"), panel)
    return (
        gold.where((F.col("region") != UNKNOWN_REGION) & (F.col("temp") > hot_day_c))
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("hot_readings"),
            settle(F.avg(loss), DIGITS, GUARD).alias("mean_loss"),
            settle(F.max(loss), DIGITS, GUARD).alias("max_loss"),
        )
        .orderBy("region")
    )


def seasonality(daily: DataFrame) -> DataFrame:
    """Standard deviation of the monthly means of solar and wind power, per region."""
    monthly = (
        _known_days(daily)
        .where(F.col("year").isNotNull())
        .groupBy("region", "year", "month")
        .agg(pooled_mean("solar").alias("solar"), pooled_mean("wind").alias("wind"))
    )
    return (
        monthly.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("months"),
            settle(F.stddev_samp("solar"), DIGITS, GUARD).alias("solar_monthly_stddev"),
            settle(F.stddev_samp("wind"), DIGITS, GUARD).alias("wind_monthly_stddev"),
        )
        .orderBy("region")
    )


def intermittency(daily: DataFrame) -> DataFrame:
    """Mean absolute change of total power from one calendar day to the next, per region."""
    change = F.abs(F.col("total") - F.col("prior_total"))
    return (
        _dated_totals(daily)
        .where(change.isNotNull())
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("day_pairs"),
            settle(F.avg(change), DIGITS, GUARD).alias("mean_day_to_day_change"),
            settle(F.max(change), DIGITS, GUARD).alias("max_day_to_day_change"),
        )
        .orderBy("region")
    )
