"""Bar volume as a share of the ticker's average day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.functions.values import safe_ratio
from sessionvol.plans.joins import lookup_join

# The mart's columns.
NORMALIZED_COLUMNS = (
    "ticker", "sector", "market_cap_band", "bar_time", "trade_date", "bar_hour", "bar_minute",
    "minutes_since_open", "day_of_week", "open", "high", "low", "close", "volume",
    "avg_daily_volume", "normalized_volume",
)


def daily_total_volume(staged: DataFrame) -> DataFrame:
    return staged.groupBy("ticker", "trade_date").agg(F.sum("volume").alias("daily_total_volume"))


def avg_daily_volume(totals: DataFrame) -> DataFrame:
    return totals.groupBy("ticker").agg(F.avg("daily_total_volume").alias("avg_daily_volume"))


def normalized_volume(staged: DataFrame, averages: DataFrame | None = None, size: int | None = None) -> DataFrame:
    """Staged bars with their ticker's average day and their share of it.

    The shares of an average day add up to 1; a single bar is a few hundredths.  The
    averages take one pass over four columns and are then a lookup, so the bars
    themselves are not shuffled.  Pass ``averages`` to reuse those of an earlier run, with their ``size`` in
    bytes if it was measured; without both, the averages are computed and measured when called.
    Bars without a ticker are those of one ticker.
    """
    if averages is None:
        averages = avg_daily_volume(daily_total_volume(staged))
    joined = lookup_join(staged, averages.select("ticker", "avg_daily_volume"), ["ticker"], null_safe=True, size=size, spread=("bar_time",))
    share = safe_ratio(F.col("volume"), F.col("avg_daily_volume"))
    return joined.withColumn("normalized_volume", share).select(*NORMALIZED_COLUMNS)
