"""Counts of values that did not make it from bronze into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.config import REGIONS, UNKNOWN_REGION, Region
from heliovane.functions.places import with_region
from heliovane.operators.silver import FEED_PATHS, HISTORY_PATHS, feed_fields, history_fields
from heliovane.schemas import CORRUPT


def _rejects(
    raw: DataFrame,
    feed: str,
    paths: dict[str, str],
    fields: dict[str, Column],
    regions: tuple[Region, ...],
) -> DataFrame:
    """One scan and one global aggregate, then one output row per counter.

    A record that is not JSON counts as that, not as one that lacks all fields.
    """
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    checked = raw.select(
        corrupt.alias("corrupt"),
        *[F.col(paths[name]).isNull().alias(f"{name}_absent") for name in fields],
        *[column.alias(name) for name, column in fields.items()],
    )
    read = ~F.col("corrupt")
    counters = {
        ("record", "corrupt"): F.count_if("corrupt"),
        ("region", "unknown"): F.count_if(read & (F.col("region") == UNKNOWN_REGION)),
    }
    for name in fields:
        absent = F.col(f"{name}_absent")
        counters[name, "missing"] = F.count_if(read & absent)
        counters[name, "malformed"] = F.count_if(~absent & F.col(name).isNull())
    totals = with_region(checked, regions).agg(
        *[count.alias("_".join(key)) for key, count in counters.items()]
    )
    lines = [
        F.struct(
            F.lit(feed).alias("feed"),
            F.lit(field).alias("field"),
            F.lit(reason).alias("reason"),
            F.col(f"{field}_{reason}").alias("rows"),
        )
        for field, reason in counters
    ]
    return totals.select(F.inline(F.array(*lines)))


def reject_report(
    history_raw: DataFrame, feed_raw: DataFrame, regions: tuple[Region, ...] = REGIONS
) -> DataFrame:
    """``feed, field, reason, rows``: corrupt, missing, malformed, or outside every known region."""
    history = _rejects(history_raw, "historical", HISTORY_PATHS, history_fields(), regions)
    feed = _rejects(feed_raw, "hourly", FEED_PATHS, feed_fields(), regions)
    return history.unionByName(feed)
