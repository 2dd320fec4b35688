"""Bronze to silver: flatten both feeds, put them under one another, add calendar and region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.config import COORDINATE_DECIMALS, REGIONS, Region
from heliovane.functions.clock import calendar_columns
from heliovane.functions.convert import to_double, to_int, to_long
from heliovane.functions.places import with_region
from heliovane.schemas import OBSERVATION

# Silver column -> path inside a bronze record.
HISTORY_PATHS = {
    "dt": "dt",
    "lat": "lat",
    "lon": "lon",
    "uvi": "uv_index",
    "temp": "main.temp",
    "pressure": "main.pressure",
    "humidity": "main.humidity",
    "wind_speed": "wind.speed",
}

FEED_PATHS = {
    "dt": "_airbyte_data.current.dt",
    "lat": "_airbyte_data.lat",
    "lon": "_airbyte_data.lon",
    "uvi": "_airbyte_data.current.uvi",
    "temp": "_airbyte_data.current.temp",
    "pressure": "_airbyte_data.current.pressure",
    "humidity": "_airbyte_data.current.humidity",
    "wind_speed": "_airbyte_data.current.wind_speed",
}

CONVERTERS = {"bigint": to_long, "double": to_double, "int": to_int}


def _typed(paths: dict[str, str]) -> dict[str, Column]:
    return {
        f.name: CONVERTERS[f.dataType.simpleString()](F.col(paths[f.name]))
        for f in OBSERVATION.fields
    }


def history_fields() -> dict[str, Column]:
    """Silver name -> expression over a historical record. Only here are coordinates rounded."""
    fields = _typed(HISTORY_PATHS)
    for name in ("lat", "lon"):
        fields[name] = F.round(fields[name], COORDINATE_DECIMALS)
    return fields


def feed_fields() -> dict[str, Column]:
    """Silver name -> expression over an hourly feed record, coordinates as delivered."""
    return _typed(FEED_PATHS)


def flatten_history(raw: DataFrame) -> DataFrame:
    return raw.select(*[column.alias(name) for name, column in history_fields().items()])


def flatten_feed(raw: DataFrame) -> DataFrame:
    return raw.select(*[column.alias(name) for name, column in feed_fields().items()])


def unify(history: DataFrame, feed: DataFrame) -> DataFrame:
    """Both feeds, matched by column name, duplicates kept."""
    return history.unionByName(feed)


def enrich(observations: DataFrame, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    dated = observations.withColumns(calendar_columns(F.col("dt")))
    return with_region(dated, regions)


def build_silver(
    history_raw: DataFrame, feed_raw: DataFrame, regions: tuple[Region, ...] = REGIONS
) -> DataFrame:
    return enrich(unify(flatten_history(history_raw), flatten_feed(feed_raw)), regions)
