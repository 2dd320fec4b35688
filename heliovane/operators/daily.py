"""The region-day rollup every report starts from.

Whatever the input size, it has one row per region and calendar day. It holds sums and counts, not
means, so rollups of separate loads can be merged; minima and maxima merge as they are. Catalyst drops
the aggregates a report does not use, so reading it lazily from gold scans only that report's columns.

Sums are exact: values are added as whole numbers of a small unit, so neither partitions nor the order in
which parts of a sum meet, nor how often rollups are merged, can change a bit of a mean.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_KEYS = ("region", "year", "month", "day")

# Rollup prefix -> gold column.
MEASURES = {
    "solar": "potencia_solar_w",
    "wind": "potencial_eolico_w",
    "total": "potencial_renovable_total_w",
    "temp": "temp",
    "pressure": "pressure",
    "humidity": "humidity",
    "speed": "wind_speed",
    "uvi": "uvi",
}


# Values below LARGEST are added as multiples of 2**-UNIT_BITS, in limbs that hold the sums of 2**42 rows.
UNIT_BITS = 40
LIMB_BITS = 21
LIMBS = 3
LARGEST = 2.0 ** (LIMBS * LIMB_BITS - 1 - UNIT_BITS)


def _sum_columns(prefix: str) -> list[str]:
    """The columns of one sum: its limbs, lowest first, and the values too large for them."""
    return [*[f"{prefix}_limb{k}" for k in range(LIMBS)], f"{prefix}_rest"]


def _sums(prefix: str, column: str) -> list[Column]:
    value = F.col(column).cast("double")
    fits = F.abs(value) < LARGEST
    units = F.rint(value * F.lit(2.0**UNIT_BITS)).cast("bigint")
    limbs = [F.shiftright(units, k * LIMB_BITS).bitwiseAND(F.lit((1 << LIMB_BITS) - 1)) for k in range(LIMBS - 1)]
    limbs.append(F.shiftright(units, (LIMBS - 1) * LIMB_BITS))
    parts = [F.sum(F.when(fits, limb)) for limb in limbs]
    parts.append(F.sum(F.when(~fits, value)))
    return [part.alias(name) for part, name in zip(parts, _sum_columns(prefix), strict=True)]


def _total(parts: dict[str, Column], prefix: str) -> Column:
    """The sum in double precision, from the columns of it."""
    *limbs, rest = (F.coalesce(parts[name], F.lit(0)) for name in _sum_columns(prefix))
    whole = reduce(
        add, [limb.cast("decimal(20,0)") * F.lit(1 << (k * LIMB_BITS)).cast("decimal(14,0)") for k, limb in enumerate(limbs)]
    )
    return whole.cast("double") / F.lit(2.0**UNIT_BITS) + rest


def daily_metrics(gold: DataFrame) -> DataFrame:
    """Partial aggregation runs before the shuffle, so no day, however large, meets in one task."""
    parts = [F.count(F.lit(1)).alias("observations")]
    for prefix, column in MEASURES.items():
        parts += [
            *_sums(prefix, column),
            F.count(column).alias(f"{prefix}_n"),
            F.min(column).alias(f"{prefix}_min"),
            F.max(column).alias(f"{prefix}_max"),
        ]
    return gold.groupBy(*DAY_KEYS).agg(*parts)


def merge_daily(*rollups: DataFrame) -> DataFrame:
    """One rollup out of the rollups of disjoint loads."""
    stacked = reduce(DataFrame.unionByName, rollups)
    parts = [F.sum("observations").alias("observations")]
    for prefix in MEASURES:
        parts += [
            *[F.sum(name).alias(name) for name in (*_sum_columns(prefix), f"{prefix}_n")],
            F.min(f"{prefix}_min").alias(f"{prefix}_min"),
            F.max(f"{prefix}_max").alias(f"{prefix}_max"),
        ]
    return stacked.groupBy(*DAY_KEYS).agg(*parts)


def mean_of(prefix: str) -> Column:
    """Mean of one measure over a rollup row; null where no value was present."""
    return F.try_divide(_total({name: F.col(name) for name in _sum_columns(prefix)}, prefix), F.col(f"{prefix}_n"))


def pooled_mean(prefix: str) -> Column:
    """Mean over all observations of the rollup rows in a group."""
    return F.try_divide(_total({name: F.sum(name) for name in _sum_columns(prefix)}, prefix), F.sum(f"{prefix}_n"))


def only_in(region: str, value: Column) -> Column:
    """``value`` on the rows of one region, null elsewhere: the input of a pivoting aggregate."""
    return F.when(F.col("region") == region, value)
