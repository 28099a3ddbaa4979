"""Rolling realised volatility per ticker and its high/low regime."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.functions.values import annualised
from sessionvol.operators.staging import day_blocks
from sessionvol.plans.joins import lookup_join
from sessionvol.plans.middle import SORT_ROWS, group_summary
from sessionvol.plans.ordered import BLOCK_ROWS, block_window, own_rows
from sessionvol.session import settle

FRAME_ROWS = 20  # days in the rolling frame


def realized_volatility(
    days: DataFrame, min_periods: int = 1, precision: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """ticker, trade_date, daily_return, realized_vol_20d; days without one are dropped.

    ``days`` are raw or staged daily bars: the filter and the returns are the same on
    both.  A block needs the 19 rows before its first one, and one more for the return.
    ``min_periods`` is the least number of returns in the frame (20: full frames only).
    ``precision`` rounds to that many decimals, so that a later comparison does not
    depend on last bits.
    """
    frame = block_window("ticker").rowsBetween(1 - FRAME_ROWS, 0)
    value = annualised(F.stddev_pop("daily_return").over(frame))
    if precision is not None:
        value = F.round(value, precision)
    enough = F.count("daily_return").over(frame) >= min_periods
    blocks = day_blocks(days, FRAME_ROWS, block_rows)
    rolled = blocks.withColumn("realized_vol_20d", F.when(enough, value))
    return (
        own_rows(rolled)
        .where(F.col("realized_vol_20d").isNotNull())
        .select("ticker", "trade_date", "daily_return", "realized_vol_20d")
    )


def vol_threshold(volatility: DataFrame, sort_rows: int = SORT_ROWS) -> DataFrame:
    """Upper median of each ticker's whole history: element n // 2 of the sorted values."""
    middles = group_summary(volatility, ["ticker"], "realized_vol_20d", sort_rows=sort_rows)
    return middles.select("ticker", F.col("upper").alias("vol_threshold"))


def daily_volatility(
    days: DataFrame, min_periods: int = 1, precision: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Volatility with its regime: 'high' strictly above the ticker's threshold, else 'low'.

    Runs jobs when called: positions, volatilities and thresholds are stored.
    """
    rated = settle(realized_volatility(days, min_periods, precision, block_rows))
    joined = lookup_join(rated, vol_threshold(rated), ["ticker"], null_safe=True, spread=("trade_date",))
    value = F.col("realized_vol_20d")
    above = (value > F.col("vol_threshold")) & ~F.isnan(value)
    return joined.withColumn("vol_regime", F.when(above, "high").otherwise("low")).drop("vol_threshold")
