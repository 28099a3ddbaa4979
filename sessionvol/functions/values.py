"""Scalar expressions on prices, volumes and capitalisations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Market-cap bands and their lower bounds.
LARGE_FROM = 10_000_000_000
MID_FROM = 2_000_000_000
CAP_BANDS = ("large", "mid", "small", "unknown")

# Volatility regimes and trading days in a year.
REGIMES = ("high", "low")
TRADING_DAYS = 252


def cap_band(cap: Column) -> Column:
    """Band of a market capitalisation.  NaN counts as missing: Spark sorts it
    above every number, so it would otherwise come out as large."""
    return (
        F.when(cap.isNull() | F.isnan(cap), "unknown")
        .when(cap >= LARGE_FROM, "large")
        .when(cap >= MID_FROM, "mid")
        .otherwise("small")
    )


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL where whole is 0 (ANSI division would raise)."""
    return part / F.nullif(whole, F.lit(0.0))


def annualised(deviation: Column) -> Column:
    return deviation * F.sqrt(F.lit(float(TRADING_DAYS)))
