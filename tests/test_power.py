from __future__ import annotations

import math
from itertools import product

import pytest
from conftest import NOON, PATAGONIA

from heliovane.config import SolarPanel, WindTurbine
from heliovane.operators.gold import build_gold
from heliovane.schemas import POWER_COLUMNS


def powers(silver, uvi, temp, pressure, speed, **params):
    row = build_gold(silver((NOON, PATAGONIA, uvi, temp, pressure, speed)), **params).first()
    return tuple(row[name] for name in POWER_COLUMNS)


@pytest.mark.parametrize(
    "uvi, temp, pressure, speed, solar, wind",
    [
        (3.2, 31.0, 1010, 7.1, 42.1632, 82.809668),
        (1.0, 10.0, 1000, 2.0, 13.5, 1.96854735),
        (1.0, 25.0, 1000, 0.0, 13.5, 0.0),
        (1.0, None, 1000, 2.0, 13.5, None),
        (None, 10.0, 1000, 2.0, None, 1.96854735),
        (1.0, 10.0, None, 2.0, 13.5, None),
        (1.0, 10.0, 1000, None, 13.5, None),
        (1.0, -273.15, 1000, 2.0, 13.5, None),
        (1.0, 10.0, 2_147_483_647, 2.0, 13.5, 1.96854735 * 2_147_483.647),
    ],
)
def test_known_values(silver, uvi, temp, pressure, speed, solar, wind):
    got_solar, got_wind, total = powers(silver, uvi, temp, pressure, speed)
    assert got_solar == (None if solar is None else pytest.approx(solar, rel=1e-8))
    assert got_wind == (None if wind is None else pytest.approx(wind, rel=1e-8))
    if solar is None or wind is None:
        assert total is None
    else:
        assert total == got_solar + got_wind


def test_no_clamp_on_extreme_heat(silver):
    assert powers(silver, 1.0, 300.0, 1000, 1.0)[0] < 0


def test_parameters(silver):
    solar, wind, _ = powers(
        silver,
        1.0,
        10.0,
        1000,
        2.0,
        panel=SolarPanel(efficiency=0.36),
        turbine=WindTurbine(power_coefficient=0.2),
    )
    assert solar == pytest.approx(27.0)
    assert wind == pytest.approx(1.96854735 / 2, rel=1e-8)


def test_properties_over_a_grid(silver):
    uvis, temps, speeds = (0.5, 1.0, 2.0), (-5.0, 10.0, 25.0, 26.0, 40.0), (1.0, 2.0, 4.0)
    rows = [(NOON, PATAGONIA, u, t, 1000, v) for u, t, v in product(uvis, temps, speeds)]
    gold = {
        (r.uvi, r.temp, r.wind_speed): (r.potencia_solar_w, r.potencial_eolico_w)
        for r in build_gold(silver(*rows)).collect()
    }
    for u, t, v in product(uvis, temps, speeds):
        solar, wind = gold[u, t, v]
        assert math.isclose(solar, u * gold[1.0, t, v][0])
        assert math.isclose(wind, v**3 * gold[u, t, 1.0][1])
        if t <= 25:
            assert solar == gold[u, 10.0, v][0]
        else:
            assert solar < gold[u, 25.0, v][0]
        warmer = [gold[u, other, v][1] for other in temps if other > t]
        assert all(w < wind for w in warmer)
