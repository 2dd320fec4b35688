from __future__ import annotations

import pytest
from conftest import NOON, NOWHERE, PATAGONIA, RIOHACHA
from pyspark.sql import functions as F

from heliovane.config import REGIONS, Region, check_catalog
from heliovane.functions import places
from heliovane.functions.places import region_name, with_region
from heliovane.operators.gold import build_gold
from heliovane.operators.silver import build_silver, enrich, flatten_feed, flatten_history, unify
from heliovane.schemas import FEED_BRONZE, HISTORY_BRONZE, OBSERVATION, SILVER


def history(spark, **fields):
    record = {"dt": None, "lat": None, "lon": None, "uv_index": None, "main": {}, "wind": {}}
    return spark.createDataFrame([record | fields], HISTORY_BRONZE)


def feed(spark, lat=None, lon=None, **current):
    return spark.createDataFrame(
        [{"_airbyte_data": {"lat": lat, "lon": lon, "current": current}}], FEED_BRONZE
    )


def observations(spark, *rows):
    full = [(dt, lat, lon, 1.0, 1.0, 1000, 50, 1.0) for dt, lat, lon in rows]
    return spark.createDataFrame(full, OBSERVATION)


def test_history_is_flattened_and_typed(spark):
    raw = history(
        spark,
        dt="1704067200",
        lat="-41.810145",
        lon="-68.9063",
        uv_index="3.2",
        main={"temp": "31", "pressure": "1010.7", "humidity": "40"},
        wind={"speed": "7.1"},
    )
    flat = flatten_history(raw)
    assert flat.schema == OBSERVATION
    assert tuple(flat.first()) == (1704067200, -41.8101, -68.9063, 3.2, 31.0, 1010, 40, 7.1)


def test_feed_coordinates_are_not_rounded(spark):
    flat = flatten_feed(feed(spark, lat="-41.81012", lon="-68.9063", dt="1", uvi="1"))
    assert flat.schema == OBSERVATION
    assert flat.first().lat == -41.81012


@pytest.mark.parametrize(
    "text, pressure",
    [("x", None), ("31", 31), ("1010.7", 1010), ("99999999999", None), ("", None), (" 7 ", 7)],
)
def test_malformed_numbers_become_null(spark, text, pressure):
    assert flatten_feed(feed(spark, pressure=text)).first().pressure == pressure


@pytest.mark.parametrize(
    "text, dt",
    [("1704067200", 1704067200), ("1704067200.9", 1704067200), ("1.7040672E9", 1704067200),
     ("9007199254740993", 9007199254740993), ("soon", None), ("1e30", None)],
)
def test_epoch_seconds(spark, text, dt):
    assert flatten_feed(feed(spark, dt=text)).first().dt == dt


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_values_are_nulls_with_and_without_ansi(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    bad = feed(spark, lat="x", lon="1e999", dt="10000000000000000000", uvi="--", temp="-273.15",
               pressure="1e300", humidity="7.9", wind_speed="2")
    row = build_gold(enrich(flatten_feed(bad))).first()
    assert (row.dt, row.lat, row.uvi, row.pressure, row.humidity) == (None, None, None, None, 7)
    assert (row.potencia_solar_w, row.potencial_eolico_w, row.year) == (None, None, None)
    zero = feed(spark, dt="0", uvi="1", temp="-273.15", pressure="1000", wind_speed="2")
    row = build_gold(enrich(flatten_feed(zero))).first()
    assert (row.potencia_solar_w, row.potencial_eolico_w, row.year) == (13.5, None, 1970)


def test_missing_structs_give_null_fields(spark):
    raw = spark.createDataFrame([{"dt": "5", "main": None, "wind": None}], HISTORY_BRONZE)
    assert tuple(flatten_history(raw).first()) == (5, *[None] * 7)


@pytest.mark.parametrize("zone", ["UTC", "America/Bogota", "Pacific/Auckland"])
def test_calendar_is_utc_in_any_session(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    row = enrich(observations(spark, (1704067200, *PATAGONIA))).first()
    assert (row.timestamp, row.year, row.month, row.day) == ("2024-01-01 00:00:00", 2024, 1, 1)


@pytest.mark.parametrize(
    "dt, text, date",
    [
        (-1, "1969-12-31 23:59:59", (1969, 12, 31)),
        (951782400, "2000-02-29 00:00:00", (2000, 2, 29)),
        (1704067200000, "+55969-09-28 00:00:00", (55969, 9, 28)),
        (2**63 - 1, None, (None, None, None)),
        (-(2**63), None, (None, None, None)),
        (None, None, (None, None, None)),
    ],
)
def test_calendar_extremes(spark, dt, text, date):
    row = enrich(observations(spark, (dt, *PATAGONIA))).first()
    assert (row.timestamp, (row.year, row.month, row.day)) == (text, date)


@pytest.mark.parametrize(
    "lat, lon, region",
    [
        (*PATAGONIA, "Patagonia"),
        (*RIOHACHA, "Riohacha"),
        (PATAGONIA[0], RIOHACHA[1], "No Region"),
        (-41.81012, -68.9063, "No Region"),
        (None, -68.9063, "No Region"),
        (-41.8101, None, "No Region"),
        (*NOWHERE, "No Region"),
    ],
)
def test_region(spark, lat, lon, region):
    assert enrich(observations(spark, (NOON, lat, lon))).first().region == region


@pytest.mark.parametrize("broadcast_limit", [100_000, 0])
def test_long_catalog_joins_to_the_same_regions(spark, monkeypatch, broadcast_limit):
    monkeypatch.setattr(places, "BROADCAST_LIMIT", broadcast_limit)
    many = REGIONS + tuple(Region(f"R{i}", float(i), float(-i), f"r{i}", f"r{i}") for i in range(1, 60))
    points = [(1, *PATAGONIA), (2, *NOWHERE), (3, 7.0, -7.0), (4, None, 1.0), (5, 7.0, 7.0)]
    rows = observations(spark, *points)
    joined = with_region(rows, many)
    assert joined.columns == [*rows.columns, "region"]
    expected = rows.withColumn("region", region_name(F.col("lat"), F.col("lon"), many))
    assert sorted(r.region for r in joined.collect()) == sorted(r.region for r in expected.collect())
    assert {r.dt: r.region for r in joined.collect()} == {
        1: "Patagonia", 2: "No Region", 3: "R7", 4: "No Region", 5: "No Region"
    }


def test_ambiguous_catalog_is_refused():
    twin = Region("Twin", *PATAGONIA, "twin", "twn")
    with pytest.raises(ValueError):
        check_catalog((*REGIONS, twin))


def test_union_matches_names_and_keeps_duplicates(spark):
    one = observations(spark, (NOON, *PATAGONIA))
    other = one.select(*reversed(one.columns))
    both = unify(one, other).collect()
    assert len(both) == 2 and both[0] == both[1]
    with pytest.raises(Exception, match="dt"):
        unify(one, other.drop("dt")).collect()


def test_silver_columns(spark):
    silver = build_silver(history(spark, dt="1"), feed(spark, dt="2"))
    assert sorted(silver.columns) == sorted(SILVER.names)
    types = {f.name: f.dataType for f in SILVER.fields}
    assert {f.name: f.dataType for f in silver.schema.fields} == types
