import sys
from datetime import date
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bazaarline.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


def months(start: date, n: int) -> list[date]:
    first = start.year * 12 + start.month - 1
    return [date((first + i) // 12, (first + i) % 12 + 1, start.day) for i in range(n)]


def wave(i: int, level: float, reach: float) -> float:
    """A price that drifts and swings: plain arithmetic, no two neighbours alike."""
    return round(level + reach * (((i * 37) % 23) / 11.5 - 1) + 0.05 * i, 2)


@pytest.fixture(scope="session")
def clean_rows():
    """Four series of five years without anything odd."""
    names = [(p, r) for p in ("Figs", "Lentils") for r in ("North", "South")]
    rows = [
        (d, product, region, wave(i + 5 * k, 60 + 15 * k, 9))
        for k, (product, region) in enumerate(names)
        for i, d in enumerate(months(date(2019, 7, 1), 60))
    ]
    return pd.DataFrame(rows, columns=["date", "product", "region", "price"])


SPIKES = (14, 37, 59)


@pytest.fixture(scope="session")
def spiked_rows():
    """Four series of six years; three months of each cost two and a half times as much."""
    names = [(p, r) for p in ("Tomates", "Lamb") for r in ("Alger", "South")]
    rows = [
        (d, product, region, wave(i + 7 * k, 90 + 130 * k, 4 + 6 * k) * (2.5 if i in SPIKES else 1.0), 0.0)
        for k, (product, region) in enumerate(names)
        for i, d in enumerate(months(date(2017, 3, 1), 72))
    ]
    return pd.DataFrame(rows, columns=["date", "product", "region", "price", "pct_change_1m"])


@pytest.fixture(scope="session")
def panel(spark, clean_rows):
    return spark.createDataFrame(clean_rows).cache()


@pytest.fixture(scope="session")
def spiked(spark, spiked_rows):
    return spark.createDataFrame(spiked_rows).cache()
