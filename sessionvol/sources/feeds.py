"""Vendor feeds to raw tables: names, times, stamps, union."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionvol.functions.clock import utc_wall_time
from sessionvol.operators.metadata import universe_join, with_cap_band, with_metadata_defaults
from sessionvol.plans.joins import lookup_join
from sessionvol.schemas import DAILY_BARS, INTRADAY_BARS, RAW, TICKER_METADATA

INTERVAL = "5m"  # fixed value: length of the vendor's bars

# vendor's metadata names, in lower case, and ours.
METADATA_NAMES = {"symbol": "ticker", "longname": "company_name", "marketcap": "market_cap"}

_FIRST_OF_TUPLE = re.compile(r"""^\(\s*['"]?([^,'"]+)['"]?\s*,.*\)$""")


def feed_name(name: str) -> str:
    """Lower-case column name; of a ('Close', 'ABC') pair only the first part."""
    pair = _FIRST_OF_TUPLE.match(name)
    return (pair.group(1) if pair else name).strip().lower()


def read_feed(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """All tickers' CSV files in one scan, from folders named ``ticker=ABC``.

    ``columns`` maps lower-case names, as ``feed_name`` gives them, to types.  The order of columns is that of the
    files' header: one header is read first, columns are found in it by name, and a file
    with another header is an error.  Columns that are not named are left out.
    """
    options = {"header": True, "basePath": path}
    found = [c for c in spark.read.options(inferSchema=False, **options).csv(path).columns if c != "ticker"]
    names = [feed_name(c) for c in found]
    lacking = [c for c in columns if c not in (*names, "ticker")]
    if lacking:
        raise ValueError(f"{path} has no column {', '.join(lacking)}; its header is {found}")
    types = [f"`{c.replace('`', '``')}` {columns.get(n, 'string')}" for c, n in zip(found, names, strict=True)]
    schema = ", ".join([*types, "ticker string"])
    rows = spark.read.schema(schema).options(enforceSchema=False, mode="FAILFAST", **options).csv(path)
    return rows.toDF(*names, "ticker").select(*columns, *(["ticker"] if "ticker" not in columns else []))


def _stamp(df: DataFrame, name: str, run_time: datetime | str | None) -> DataFrame:
    """Load time where the feed gives none: ``run_time``, by default now, in whole seconds."""
    moment = run_time or datetime.now(UTC)
    text = moment.strftime("%Y-%m-%d %H:%M:%S") if isinstance(moment, datetime) else moment
    value: Column = F.date_format(F.lit(text).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")
    if name in df.columns:
        value = F.coalesce(F.col(name).cast("timestamp_ntz"), value)
    return df.withColumn(name, value)


def _renamed(feed: DataFrame, ticker: str | None, time_names: Sequence[str], target: str) -> DataFrame:
    df = feed.toDF(*[feed_name(c) for c in feed.columns])
    found = next(c for c in (*time_names, target) if c in df.columns)
    df = df.withColumnRenamed(found, target)
    return df.withColumn("ticker", F.lit(ticker)) if ticker else df


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def ingest_intraday(
    feed: DataFrame,
    instruments: DataFrame,
    run_time: datetime | str | None = None,
    ticker: str | None = None,
    interval: str = INTERVAL,
) -> DataFrame:
    """Raw bars from vendor bars.

    ``instruments`` (ticker, sector, market_cap_band) stamps each bar; a ticker it does
    not hold gets band 'unknown'.  ``ticker`` stamps a feed of a single instrument.
    Times become UTC wall times.
    """
    df = _renamed(feed, ticker, ("datetime", "date"), "bar_time")
    df = df.withColumn("bar_time", utc_wall_time(F.col("bar_time"), df.schema["bar_time"].dataType))
    df = lookup_join(
        df.drop("sector", "market_cap_band"),
        instruments.select("ticker", "sector", "market_cap_band"),
        ["ticker"],
    )
    df = df.withColumn("market_cap_band", F.coalesce(F.col("market_cap_band"), F.lit("unknown")))
    df = _stamp(df.withColumn("interval", F.lit(interval)), "ingested_at", run_time)
    return _typed(df, INTRADAY_BARS)


def ingest_daily(
    feed: DataFrame, run_time: datetime | str | None = None, ticker: str | None = None
) -> DataFrame:
    """Raw days from vendor days.  A zoned time counts as the day it names, not as its UTC day."""
    df = _renamed(feed, ticker, ("date", "datetime"), "trade_date")
    df = df.withColumn("trade_date", F.col("trade_date").cast("timestamp_ntz").cast("date"))
    return _typed(_stamp(df, "ingested_at", run_time), DAILY_BARS)


def ingest_metadata(
    feed: DataFrame, universe: DataFrame, run_time: datetime | str | None = None
) -> DataFrame:
    """Raw metadata from vendor records: the universe's sector, defaults and the cap band.

    Records of tickers outside the universe are left out; ``foreign_tickers`` reports them.
    """
    df = feed.toDF(*[feed_name(c) for c in feed.columns]).withColumnsRenamed(METADATA_NAMES)
    df = lookup_join(df.drop("sector"), universe.select("ticker", "sector"), ["ticker"], "inner")
    df = with_cap_band(with_metadata_defaults(df))
    return _typed(_stamp(df, "fetched_at", run_time), TICKER_METADATA)


def union_feeds(feeds: Sequence[DataFrame], relation: str) -> DataFrame:
    """Feeds of one relation under each other, columns matched by name; no shuffle."""
    columns = RAW[relation].fieldNames()
    return reduce(DataFrame.unionByName, [feed.select(*columns) for feed in feeds])


def instruments(universe: DataFrame, metadata: DataFrame) -> DataFrame:
    """ticker, sector and band of every ticker of the universe, for ``ingest_intraday``."""
    return universe_join(universe, metadata).select("ticker", "sector", "market_cap_band")
