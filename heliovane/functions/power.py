"""Solar and wind power of one observation.

Multiplication runs left to right in a fixed order: doubles are not associative, and the order
decides the last bits of the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heliovane.config import PANEL, TURBINE, SolarPanel, WindTurbine


def heat_loss(temp: Column, panel: SolarPanel = PANEL) -> Column:
    """Share of output lost above the rated temperature; an unknown temperature loses nothing."""
    excess = F.greatest(temp - F.lit(panel.rated_temp_c), F.lit(0.0))
    return excess * F.lit(panel.loss_per_degree)


def solar_power(uvi: Column, temp: Column, panel: SolarPanel = PANEL) -> Column:
    irradiance = uvi * F.lit(panel.watts_per_uvi)
    nominal = irradiance * F.lit(panel.efficiency)
    return nominal * (F.lit(1.0) - heat_loss(temp, panel)) * F.lit(panel.performance_ratio)


def air_density(pressure: Column, temp: Column, turbine: WindTurbine = TURBINE) -> Column:
    """Ideal gas law, kg per cubic metre; null at absolute zero instead of a failed job."""
    pascals = pressure * F.lit(turbine.pascals_per_hpa)
    kelvins = temp + F.lit(turbine.kelvin_at_zero_c)
    return F.try_divide(pascals, F.lit(turbine.dry_air_gas_constant) * kelvins)


def wind_power(
    pressure: Column, temp: Column, wind_speed: Column, turbine: WindTurbine = TURBINE
) -> Column:
    cubed = wind_speed * wind_speed * wind_speed
    kinetic = air_density(pressure, temp, turbine) * F.lit(turbine.kinetic_factor) * cubed
    return kinetic * F.lit(turbine.power_coefficient)
