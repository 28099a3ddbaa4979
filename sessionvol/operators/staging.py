"""Cleaned bars, cleaned days with returns, cleaned metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.functions.clock import UTC_SESSION, TradingSession
from sessionvol.operators.metadata import latest_sql
from sessionvol.plans.ordered import BLOCK_ROWS, block_window, ordered_blocks, with_previous

# NaN passes "> 0" in Spark, so it is named.
TRADED = "volume > 0 and close > 0 and not isnan(close)"

# Order of a ticker's days.  Several loads of one day follow each other by load time; the
# returns depend on nothing behind the close, which is why volatility leaves that out.
CLOSE_ORDER = ("trade_date", "ingested_at", "close")
DAY_ORDER = (*CLOSE_ORDER, "volume", "open", "high", "low")


def intraday_columns(session: TradingSession = UTC_SESSION) -> dict[str, str]:
    """Column -> SQL text of the staged bars, in order."""
    kept = {c: c for c in ("ticker", "sector", "market_cap_band", "bar_time")}
    prices = {c: c for c in ("open", "high", "low", "close")}
    rest = {"volume": "cast(volume as bigint)", "interval": "`interval`", "ingested_at": "ingested_at"}
    return kept | session.columns() | prices | rest


def intraday_condition(session: TradingSession = UTC_SESSION) -> str:
    return f"{TRADED} and {session.contains()}"


def stg_intraday_bars(bars: DataFrame, session: TradingSession = UTC_SESSION) -> DataFrame:
    """Bars of the trading session that traded, with their time dimensions."""
    return bars.where(intraday_condition(session)).select(
        *[F.expr(text).alias(name) for name, text in intraday_columns(session).items()]
    )


def day_blocks(
    days: DataFrame, lookback: int, block_rows: int = BLOCK_ROWS, order: Sequence[str] = CLOSE_ORDER
) -> DataFrame:
    """Traded days in blocks, with the return on the previous traded day.

    The filter comes first: the previous close skips days without volume.  A ticker's
    first day has no return.  Days without a ticker are those of one ticker.  Only the columns of the order are
    kept.  Runs a job when called.
    """
    traded = days.where(TRADED).select("ticker", *order)
    blocks = ordered_blocks(traded, "ticker", order, lookback, block_rows)
    previous = F.lag("close").over(block_window("ticker"))
    return blocks.withColumn("daily_return", F.col("close") / previous - 1)


def daily_sql(days: str) -> str:
    """SQL text of the staged days of a relation.

    The previous close is looked for among the day's own loads first, else it is the last one of the ticker's traded
    day before.  So a window holds the loads of one day, or one row per day of a ticker.
    """
    within = ", ".join(c for c in DAY_ORDER if c != "trade_date")
    newest = ", ".join(c for c in CLOSE_ORDER if c != "trade_date")
    return f"""
        SELECT d.ticker, d.trade_date, open, high, low, close, cast(volume AS bigint) AS volume,
          close / coalesce(lag(close) OVER (PARTITION BY d.ticker, d.trade_date ORDER BY {within}), close_before) - 1 AS daily_return,
          ingested_at
        FROM {days} d JOIN (
          SELECT ticker, trade_date, lag(last_close) OVER (PARTITION BY ticker ORDER BY trade_date) AS close_before
          FROM (
            SELECT ticker, trade_date, max_by(close, struct({newest})) AS last_close
            FROM {days} WHERE {TRADED} GROUP BY ticker, trade_date
          )
        ) b ON d.ticker <=> b.ticker AND d.trade_date <=> b.trade_date
        WHERE {TRADED}"""


def stg_daily_bars(days: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Traded days with the return on the previous traded day.

    The same rows as the view of the layers, which stores nothing but reads the days twice.  Here the days are read once, stored in order,
    and a ticker or a day of any number of rows is spread over tasks.  Runs a job when called.
    """
    traded = days.where(TRADED).withColumn("volume", F.col("volume").cast("bigint"))
    found = with_previous(traded, "ticker", DAY_ORDER, "close", "_close_before", block_rows)
    return found.select(
        "ticker", "trade_date", "open", "high", "low", "close", "volume",
        (F.col("close") / F.col("_close_before") - 1).alias("daily_return"), "ingested_at",
    )


def metadata_sql(metadata: str) -> str:
    """SQL text of the latest version of every named ticker of a relation."""
    return f"SELECT * FROM ({latest_sql(metadata, where='ticker != ' + repr(''))})"


def stg_ticker_metadata(metadata: DataFrame) -> DataFrame:
    """Latest version of every named ticker; the same text as the view of the layers."""
    named = metadata.withColumn("market_cap", F.col("market_cap").cast("double"))
    return metadata.sparkSession.sql(metadata_sql("{metadata}"), metadata=named)
