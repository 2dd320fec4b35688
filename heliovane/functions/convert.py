"""Number conversion that keeps a bad value from failing a whole batch, and stable rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def to_int(value: Column) -> Column:
    """Through double, so that ``1010.7`` gives 1010; text and out-of-range values give null."""
    return value.try_cast("double").try_cast("int")


def to_long(value: Column) -> Column:
    """Exact for whole numbers of any size; decimals and exponents go through double."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def settle(value: Column, digits: int, guard: int = 6) -> Column:
    """Round to ``digits`` after first rounding away the noise of floating-point summation.

    The order in which partial sums meet differs between runs and shows up in the last bits. A mean
    that is a tie on paper would then round up in one run and down in the next. Only values within
    ``10 ** -(digits + guard)`` of a tie are affected.
    """
    return F.round(F.round(value, digits + guard), digits)
