from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import sessionvol as sv
from sessionvol.functions.values import safe_ratio


def minutes(df):
    return sorted(r["minutes_since_open"] for r in df.collect())


def test_session_edges(bars):
    raw = bars(*[("A", f"2024-01-10 {t}:00", 5) for t in ("13:55", "14:00", "14:25", "14:30", "20:55", "21:00")])
    assert minutes(sv.stg_intraday_bars(raw)) == [-30, -5, 0, 385]
    assert minutes(sv.stg_intraday_bars(raw, sv.TradingSession(strict_open=True))) == [0, 385]


def test_session_that_ends_within_an_hour(bars):
    raw = bars(*[("A", f"2024-01-10 {t}:00", 5) for t in ("08:59", "09:00", "09:15", "13:14", "13:15", "13:59")])
    assert minutes(sv.stg_intraday_bars(raw, sv.TradingSession("09:15", "13:15"))) == [-15, 0, 239]
    assert minutes(sv.stg_intraday_bars(raw, sv.TradingSession("09:15", "13:15", strict_open=True))) == [0, 239]


def test_minutes_count_boundaries(bars):
    assert minutes(sv.stg_intraday_bars(bars(("A", "2024-01-10 14:29:30", 5)))) == [-1]
    assert minutes(sv.stg_intraday_bars(bars(("A", "2024-01-10 20:59:59", 5)))) == [389]


def test_daylight_time(bars):
    summer = bars(("A", "2024-07-01 13:30:00", 5))
    assert minutes(sv.stg_intraday_bars(summer)) == []
    assert minutes(sv.stg_intraday_bars(summer, sv.NEW_YORK_SESSION)) == [0]
    winter = bars(("A", "2024-01-10 14:30:00", 5))
    assert minutes(sv.stg_intraday_bars(winter, sv.NEW_YORK_SESSION)) == [0]


def test_session_time_zone_does_not_matter(spark, bars):
    raw = bars(("A", "2024-03-10 14:30:00", 5), ("A", "2024-11-03 20:55:00", 5))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = sv.stg_intraday_bars(raw).orderBy("bar_time").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r.trade_date, r.minutes_since_open) for r in rows] == [
        (date(2024, 3, 10), 0), (date(2024, 11, 3), 385)
    ]


def test_untraded_bars_are_dropped(bars):
    at = "2024-01-10 15:00:00"
    raw = bars(("A", at, 0), ("A", at, 5, 0.0), ("A", at, 5, None), ("A", at, 5, float("nan")), ("B", at, 5, 2.0))
    assert [r.ticker for r in sv.stg_intraday_bars(raw).collect()] == ["B"]


def test_weekday(bars):
    raw = bars(("A", "2026-02-16 15:00:00", 5), ("B", "2026-02-15 15:00:00", 5))
    found = {r.ticker: r.day_of_week for r in sv.stg_intraday_bars(raw).collect()}
    assert found == {"A": 1, "B": 7}


def test_columns_and_types(bars):
    staged = sv.stg_intraday_bars(bars(("A", "2024-01-10 15:00:00", 5)))
    assert dict(staged.dtypes) == {
        "ticker": "string", "sector": "string", "market_cap_band": "string", "bar_time": "timestamp_ntz",
        "trade_date": "date", "bar_hour": "int", "bar_minute": "int", "minutes_since_open": "bigint",
        "day_of_week": "int", "open": "double", "high": "double", "low": "double", "close": "double",
        "volume": "bigint", "interval": "string", "ingested_at": "timestamp_ntz",
    }


def test_filter_comes_before_the_previous_close(days):
    staged = sv.stg_daily_bars(days(("A", 0, 10.0), ("A", 1, 11.0, 0), ("A", 2, 12.0)))
    rows = staged.orderBy("trade_date").collect()
    assert rows[0].daily_return is None
    assert rows[1].daily_return == pytest.approx(0.2)
    assert len(rows) == 2


def test_returns_do_not_cross_tickers(days):
    staged = sv.stg_daily_bars(days(("A", 0, 10.0), ("B", 0, 20.0), ("B", 1, 30.0), ("A", 1, 5.0)))
    found = {(r.ticker, r.trade_date.day): r.daily_return for r in staged.collect()}
    assert found == {("A", 1): None, ("A", 2): -0.5, ("B", 1): None, ("B", 2): 0.5}


def test_cap_band(spark):
    caps = [None, float("nan"), 1.99e9, 2e9, 9.99e9, 10e9]
    df = spark.createDataFrame([(c,) for c in caps], "market_cap double")
    bands = [r.market_cap_band for r in sv.with_cap_band(df).collect()]
    assert bands == ["unknown", "unknown", "small", "mid", "mid", "large"]


def test_metadata_is_named_and_latest(spark, metadata):
    raw = metadata(
        ("A", 1.0, "small", "2024-01-01"), ("A", 3e9, "mid", "2024-01-03"), ("A", 2.0, "small", "2024-01-02"),
        ("", 1.0, "small", "2024-01-01"), (None, 1.0, "small", "2024-01-01"),
    )
    rows = sv.stg_ticker_metadata(raw).collect()
    assert [(r.ticker, r.market_cap, r.market_cap_band) for r in rows] == [("A", 3e9, "mid")]


def test_zero_average_gives_null(spark):
    df = spark.createDataFrame([(5, 0.0), (5, 2.0), (5, None)], "v bigint, a double")
    found = [r.x for r in df.select(safe_ratio(F.col("v"), F.col("a")).alias("x")).collect()]
    assert found == [None, 2.5, None]


def test_metadata_defaults(spark):
    df = spark.createDataFrame(
        [("A", None, None, None, None), ("B", "n", "i", "c", "EUR")],
        "ticker string, company_name string, industry string, country string, currency string",
    )
    rows = [tuple(r) for r in sv.with_metadata_defaults(df).collect()]
    assert rows == [("A", "", "", "", "USD"), ("B", "n", "i", "c", "EUR")]


def test_universe_keeps_its_sector_and_tickers_without_metadata(spark, metadata):
    universe = spark.createDataFrame([("A", "Tech"), ("Z", "Energy")], "ticker string, sector string")
    rows = sv.universe_join(universe, metadata(("A", 3e9, "mid", "2024-01-01"))).orderBy("ticker").collect()
    assert [(r.ticker, r.sector, r.market_cap_band) for r in rows] == [
        ("A", "Tech", "mid"), ("Z", "Energy", "unknown")
    ]
    feed = spark.createDataFrame([("A",), ("A",), ("Q",)], "ticker string")
    assert [r.ticker for r in sv.missing_feeds(universe, feed).collect()] == ["Z"]
    assert {r.ticker: r.n_rows for r in sv.feed_counts(feed).collect()} == {"A": 2, "Q": 1}
