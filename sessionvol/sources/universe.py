"""The default instrument universe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Sector -> tickers.
UNIVERSE = {
    "Technology": ["AAPL", "MSFT", "NVDA", "AMD", "INTC"],
    "Communication": ["GOOGL", "META", "NFLX", "SNAP", "PINS"],
    "Consumer Discretionary": ["AMZN", "TSLA", "NKE", "MCD", "SBUX"],
    "Consumer Staples": ["PG", "KO", "PEP", "WMT", "COST"],
    "Health Care": ["JNJ", "UNH", "PFE", "ABBV", "MRNA"],
    "Financials": ["JPM", "BAC", "GS", "V", "AXP"],
    "Industrials": ["CAT", "GE", "BA", "UPS", "HON"],
    "Energy": ["XOM", "CVX", "COP", "SLB", "OXY"],
    "Materials": ["LIN", "APD", "NEM", "FCX", "ALB"],
    "Utilities": ["NEE", "DUK", "SO", "AEP", "EXC"],
    "Real Estate": ["AMT", "PLD", "EQIX", "SPG", "O"],
}


def default_universe(spark: SparkSession, sectors: dict[str, list[str]] | None = None) -> DataFrame:
    """ticker, sector; ``sectors`` replaces the default."""
    rows = [(t, s) for s, tickers in (sectors or UNIVERSE).items() for t in tickers]
    return spark.createDataFrame(rows, "ticker string, sector string")
