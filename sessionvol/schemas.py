"""Raw table schemas with column descriptions."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _field(name: str, kind, comment: str) -> StructField:
    return StructField(name, kind, True, {"comment": comment})


INTRADAY_BARS = StructType([
    _field("ticker", StringType(), "instrument symbol"),
    _field("sector", StringType(), "industry sector of the instrument"),
    _field("market_cap_band", StringType(), "large, mid, small or unknown"),
    _field("bar_time", TimestampNTZType(), "start of the bar, UTC wall time"),
    _field("open", DoubleType(), "first price in the bar"),
    _field("high", DoubleType(), "highest price in the bar"),
    _field("low", DoubleType(), "lowest price in the bar"),
    _field("close", DoubleType(), "last price in the bar"),
    _field("volume", LongType(), "units traded in the bar, never negative"),
    _field("interval", StringType(), "length of the bar, such as 5m"),
    _field("ingested_at", TimestampNTZType(), "load time, UTC wall time"),
])

TICKER_METADATA = StructType([
    _field("ticker", StringType(), "instrument symbol"),
    _field("company_name", StringType(), "full name of the issuer"),
    _field("sector", StringType(), "industry sector of the instrument"),
    _field("industry", StringType(), "industry within the sector"),
    _field("market_cap", DoubleType(), "market capitalisation in the instrument's currency"),
    _field("market_cap_band", StringType(), "large, mid, small or unknown"),
    _field("country", StringType(), "country of the issuer"),
    _field("currency", StringType(), "trading currency"),
    _field("fetched_at", TimestampNTZType(), "version time; the latest version of a ticker counts"),
])

DAILY_BARS = StructType([
    _field("ticker", StringType(), "instrument symbol"),
    _field("trade_date", DateType(), "trading day"),
    _field("open", DoubleType(), "first price of the day"),
    _field("high", DoubleType(), "highest price of the day"),
    _field("low", DoubleType(), "lowest price of the day"),
    _field("close", DoubleType(), "last price of the day"),
    _field("volume", LongType(), "units traded on the day, never negative"),
    _field("ingested_at", TimestampNTZType(), "load time, UTC wall time"),
])

# Raw relation -> schema.
RAW = {
    "intraday_bars": INTRADAY_BARS,
    "ticker_metadata": TICKER_METADATA,
    "daily_bars": DAILY_BARS,
}

# Order of rows in the written table.
SORTED_BY = {
    "intraday_bars": ("ticker", "bar_time"),
    "ticker_metadata": ("ticker",),
    "daily_bars": ("ticker", "trade_date"),
}
