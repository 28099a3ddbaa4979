from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sessionvol.schemas import DAILY_BARS, INTRADAY_BARS, TICKER_METADATA  # noqa: E402
from sessionvol.session import spark_session  # noqa: E402

LOADED = datetime(2024, 2, 1)


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def bars(spark):
    """bars((ticker, 'YYYY-MM-DD HH:MM:SS', volume[, close[, sector[, band]]]), ...)"""
    def make(*rows):
        full = []
        for row in rows:
            ticker, text, volume, close, sector, band = (*row, 1.0, "S", "large")[:6] if len(row) == 3 else (
                *row, *("S", "large")[len(row) - 4:]
            )
            full.append((ticker, sector, band, datetime.fromisoformat(text), close, close, close, close,
                         volume, "5m", LOADED))
        return spark.createDataFrame(full, INTRADAY_BARS)
    return make


@pytest.fixture
def days(spark):
    """days((ticker, day of the epoch, close[, volume]), ...)"""
    def make(*rows):
        full = [
            (r[0], date.fromordinal(date(2020, 1, 1).toordinal() + r[1]), r[2], r[2], r[2], r[2],
             r[3] if len(r) > 3 else 100, LOADED)
            for r in rows
        ]
        return spark.createDataFrame(full, DAILY_BARS)
    return make


@pytest.fixture
def metadata(spark):
    """metadata((ticker, market_cap, band, fetched_at text), ...)"""
    def make(*rows):
        full = [
            (t, f"{t} Inc", "S", "I", cap, band, "X", "USD", datetime.fromisoformat(at))
            for t, cap, band, at in rows
        ]
        return spark.createDataFrame(full, TICKER_METADATA)
    return make
