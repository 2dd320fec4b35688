"""Which region an observation point belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.config import REGIONS, UNKNOWN_REGION, Region, check_catalog

# Up to this many regions a CASE expression is cheapest: no join, no second input.
CASE_LIMIT = 32

# A catalog row is two doubles and a name; 100,000 of them stay below 10 MB on every executor.
BROADCAST_LIMIT = 100_000


def region_name(lat: Column, lon: Column, regions: tuple[Region, ...] = REGIONS) -> Column:
    """Exact match on both coordinates; a missing coordinate matches nothing."""
    matches = [F.when((lat == r.lat) & (lon == r.lon), F.lit(r.name)) for r in check_catalog(regions)]
    return F.coalesce(*matches, F.lit(UNKNOWN_REGION))


def with_region(df: DataFrame, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    """Add ``region``. Short catalogs become an expression, longer ones a join of checked size."""
    if len(regions) <= CASE_LIMIT:
        return df.withColumn("region", region_name(F.col("lat"), F.col("lon"), regions))
    check_catalog(regions)
    catalog = df.sparkSession.createDataFrame(
        [(r.lat, r.lon, r.name) for r in regions], "lat double, lon double, region string"
    )
    if len(regions) <= BROADCAST_LIMIT:
        catalog = F.broadcast(catalog)
    joined = df.join(catalog, ["lat", "lon"], "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.coalesce("region", F.lit(UNKNOWN_REGION)).alias("region"),
    )
