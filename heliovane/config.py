"""Parameters of the power model and the places the reports know about."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: they must stay as they are for results to agree -------------------------

UNKNOWN_REGION = "No Region"

COORDINATE_DECIMALS = 4

PARTITION_COLUMNS = ("region", "year", "month")


@dataclass(frozen=True)
class SolarPanel:
    """UV index in, watts out."""

    watts_per_uvi: float = 100.0
    efficiency: float = 0.18
    performance_ratio: float = 0.75
    rated_temp_c: float = 25.0
    loss_per_degree: float = 0.004


@dataclass(frozen=True)
class WindTurbine:
    """Pressure, temperature and wind speed in, watts per square metre out."""

    power_coefficient: float = 0.40
    kinetic_factor: float = 0.5
    dry_air_gas_constant: float = 287.05
    kelvin_at_zero_c: float = 273.15
    pascals_per_hpa: float = 100.0


@dataclass(frozen=True)
class Region:
    """A named observation point. ``slug`` and ``short`` build report column names."""

    name: str
    lat: float
    lon: float
    slug: str
    short: str


REGIONS = (
    Region("Patagonia", -41.8101, -68.9063, "patagonia", "pat"),
    Region("Riohacha", 11.5384, -72.9168, "riohacha", "rio"),
)

# --- End of fixed values --------------------------------------------------------------------

PANEL = SolarPanel()
TURBINE = WindTurbine()


def check_catalog(regions: tuple[Region, ...]) -> tuple[Region, ...]:
    """A point or a name listed twice would make the region of a row ambiguous."""
    points = {(r.lat, r.lon) for r in regions}
    names = {r.name for r in regions} | {UNKNOWN_REGION}
    if len(points) != len(regions) or len(names) != len(regions) + 1:
        raise ValueError("region names and coordinates must be unique")
    return regions
