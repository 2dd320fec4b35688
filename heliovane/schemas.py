"""Table layouts.

Bronze numbers are declared STRING and converted by the normalising operators. A numeric
declaration would turn quoted numbers and ``1010.7`` (for an integer) into nulls inside the JSON
parser, where no operator can see or count them; inference would cost one more pass over the input.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


# Bronze column with the text of a record that is not JSON; null for all others.
CORRUPT = "_corrupt"


def _texts(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


HISTORY_BRONZE = StructType(
    [
        *_texts("dt", "lat", "lon", "uv_index"),
        StructField("main", StructType(_texts("temp", "pressure", "humidity"))),
        StructField("wind", StructType(_texts("speed"))),
    ]
)

FEED_BRONZE = StructType(
    [
        StructField(
            "_airbyte_data",
            StructType(
                [
                    *_texts("lat", "lon"),
                    StructField(
                        "current",
                        StructType(
                            _texts("dt", "uvi", "temp", "pressure", "humidity", "wind_speed")
                        ),
                    ),
                ]
            ),
        )
    ]
)

OBSERVATION = StructType(
    [
        StructField("dt", LongType()),
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
        StructField("uvi", DoubleType()),
        StructField("temp", DoubleType()),
        StructField("pressure", IntegerType()),
        StructField("humidity", IntegerType()),
        StructField("wind_speed", DoubleType()),
    ]
)

_PARTITIONS = [
    StructField("region", StringType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
]

_SILVER_DATA = [
    *OBSERVATION.fields,
    StructField("timestamp", StringType()),
    StructField("day", IntegerType()),
]

POWER_COLUMNS = ("potencia_solar_w", "potencial_eolico_w", "potencial_renovable_total_w")

_GOLD_DATA = [*_SILVER_DATA, *[StructField(name, DoubleType()) for name in POWER_COLUMNS]]

SILVER = StructType([*_SILVER_DATA, *_PARTITIONS])
GOLD = StructType([*_GOLD_DATA, *_PARTITIONS])

# The catalog table publishes every gold column but the text timestamp.
GOLD_TABLE = StructType([f for f in GOLD.fields if f.name != "timestamp"])
