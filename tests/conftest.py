"""Shared session and the small fixture tables."""

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from storecast import schemas  # noqa: E402
from storecast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="storecast-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


W1, W2 = day("2010-02-05"), day("2010-02-12")


@pytest.fixture(scope="session")
def sales(spark):
    """Per store one series of two weeks, a falling and a rising one, and one of a single week."""
    return spark.createDataFrame([
        (1, 1, W1, 64.0, False), (1, 1, W2, 40.0, True), (1, 2, W1, 36.0, False),
        (2, 1, W1, 52.0, False), (2, 2, W1, 20.0, False), (2, 2, W2, 28.0, True),
    ], schemas.SALES)


@pytest.fixture(scope="session")
def stores(spark):
    return spark.createDataFrame([(1, "B", 90000), (2, "C", 61000)], schemas.STORES)


@pytest.fixture(scope="session")
def features(spark):
    """A week in each temperature band; one markdown per store, in different weeks."""
    return spark.createDataFrame([
        (1, W1, 30.0, 3.0, 0.0, 0.0, 0.0, 0.0, 0.0, 150.0, 6.0, False),
        (1, W2, 52.0, 3.1, 0.0, 0.0, 9.0, 0.0, 0.0, 151.0, 6.0, True),
        (2, W1, 60.0, 2.8, 4.0, 0.0, 0.0, 0.0, 0.0, 160.0, 9.0, False),
        (2, W2, 80.0, 2.9, 0.0, 0.0, 0.0, 0.0, 0.0, 162.0, 9.0, True),
    ], schemas.FEATURES)


def rows(df, *order):
    """Rows as tuples, in the order of the named columns."""
    return [tuple(r) for r in df.orderBy(*order).collect()]
