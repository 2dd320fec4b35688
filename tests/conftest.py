from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from heliovane.operators.silver import enrich  # noqa: E402
from heliovane.schemas import OBSERVATION  # noqa: E402
from heliovane.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
        spark__log__level="ERROR",
    )
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(name: str, value: str) -> None:
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


PATAGONIA = (-41.8101, -68.9063)
RIOHACHA = (11.5384, -72.9168)
NOWHERE = (0.0, 0.0)
NOON = 1_704_110_400  # 2024-01-01 12:00:00 UTC
DAY = 86_400


@pytest.fixture
def silver(spark):
    """Silver rows out of ``(dt, place, uvi, temp, pressure, wind_speed)``."""

    def build(*rows):
        full = [
            (dt, *place, uvi, temp, pressure, 50, speed)
            for dt, place, uvi, temp, pressure, speed in rows
        ]
        return enrich(spark.createDataFrame(full, OBSERVATION))

    return build


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
