"""Every registered query against its SQL. ``HELIOVANE_SF`` picks the scale."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as contract  # noqa: E402
from compare import differences, views  # noqa: E402

SF_DIR = f"/root/testdata/sf{os.environ.get('HELIOVANE_SF', '0.001')}"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def db():
    return views(SF_DIR)


def test_every_query_has_sql():
    assert set(contract.weather_queries()) == set(contract.oracle.oracle_sql())
    assert set(contract.weather_queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    report = contract.entry(spark)
    assert report.columns[:3] == ["year", "month", "day"] and report.count() > 0


@pytest.mark.parametrize("name", list(contract.weather_queries()))
def test_query_equals_sql(spark, db, name):
    assert differences(spark, db, SF_DIR, name) is None


def test_queries_do_not_depend_on_the_session_time_zone(spark, db, conf):
    conf("spark.sql.session.timeZone", "Asia/Kolkata")
    for name in ("calendar_fields", "q1_solar_daily", "stream_daily"):
        assert differences(spark, db, SF_DIR, name) is None
