"""Epoch seconds to UTC calendar values.

None of these depends on ``spark.sql.session.timeZone``, so the same table comes out of any session.
Calendar parts come from whole days since the epoch, about twenty times cheaper than parsing them
back out of the text timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400

# Seconds beyond this do not fit Spark's microsecond timestamps.
LAST_SECOND = (2**63 - 1) // 1_000_000


def representable(dt: Column) -> Column:
    """``dt`` where a timestamp can hold it, else null."""
    return F.when(dt.between(-LAST_SECOND, LAST_SECOND), dt)


def utc_date(dt: Column) -> Column:
    days = F.floor(representable(dt) / F.lit(float(SECONDS_PER_DAY)))
    return F.date_from_unix_date(days.cast("int"))


def utc_text(dt: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", representable(dt), epoch).cast("string")


def instant(dt: Column) -> Column:
    """Event time for watermarks and windows."""
    return F.timestamp_seconds(representable(dt))


def calendar_columns(dt: Column) -> dict[str, Column]:
    date = utc_date(dt)
    return {
        "timestamp": utc_text(dt),
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
    }
