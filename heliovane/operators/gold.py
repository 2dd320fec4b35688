"""Silver to gold: three power columns per observation, one narrow projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovane.config import PANEL, TURBINE, SolarPanel, WindTurbine
from heliovane.functions.power import solar_power, wind_power


def build_gold(
    silver: DataFrame, panel: SolarPanel = PANEL, turbine: WindTurbine = TURBINE
) -> DataFrame:
    temp = F.col("temp")
    solar = solar_power(F.col("uvi"), temp, panel)
    wind = wind_power(F.col("pressure"), temp, F.col("wind_speed"), turbine)
    return silver.withColumns({"potencia_solar_w": solar, "potencial_eolico_w": wind}).withColumn(
        "potencial_renovable_total_w", F.col("potencia_solar_w") + F.col("potencial_eolico_w")
    )
