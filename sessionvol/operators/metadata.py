"""Instrument metadata: bands, defaults, versions, universe, missing feeds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.functions.values import cap_band
from sessionvol.plans.joins import lookup_join
from sessionvol.schemas import TICKER_METADATA


def with_cap_band(df: DataFrame, cap: str = "market_cap") -> DataFrame:
    return df.withColumn("market_cap_band", cap_band(F.col(cap)))


def with_metadata_defaults(df: DataFrame) -> DataFrame:
    """Empty texts, and US dollars, where the vendor gives nothing."""
    # What a missing field becomes.
    defaults = {"company_name": "", "industry": "", "country": "", "currency": "USD"}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def latest_sql(metadata: str, where: str = "true") -> str:
    """SQL text of the version with the largest fetched_at per ticker of a relation."""
    columns = TICKER_METADATA.fieldNames()
    rest = ", ".join(c for c in columns if c not in ("ticker", "fetched_at"))
    taken = ", ".join(c if c == "ticker" else f"newest.{c}" for c in columns)
    return (
        f"SELECT {taken} FROM (SELECT ticker, max(struct(fetched_at, {rest})) AS newest "
        f"FROM {metadata} WHERE {where} GROUP BY ticker)"
    )


def latest_metadata(metadata: DataFrame) -> DataFrame:
    """Version with the largest fetched_at per ticker.

    ``max`` of a struct is combined map-side, so many versions of one ticker are reduced
    before the shuffle.  Versions of the same time are settled by the other columns.
    """
    return metadata.sparkSession.sql(latest_sql("{metadata}"), metadata=metadata)


def universe_join(universe: DataFrame, metadata: DataFrame) -> DataFrame:
    """Universe (ticker, sector) with its latest metadata.

    The sector is the universe's own.  A ticker without metadata stays, with band
    'unknown'.
    """
    versions = latest_metadata(metadata).drop("sector")
    joined = lookup_join(universe.select("ticker", "sector"), versions, ["ticker"])
    band = F.coalesce(F.col("market_cap_band"), F.lit("unknown"))
    return joined.withColumn("market_cap_band", band).select(*TICKER_METADATA.fieldNames())


def missing_feeds(universe: DataFrame, feed: DataFrame) -> DataFrame:
    """Tickers of the universe for which the feed has no row."""
    seen = feed.select("ticker").distinct()
    return universe.select("ticker", "sector").join(seen, "ticker", "left_anti")


def foreign_tickers(universe: DataFrame, feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per feed and ticker that the universe does not hold: (feed, ticker, n_rows).

    Metadata of such tickers is left out, their bars stay without a sector.
    """
    known = universe.select("ticker").distinct()
    counted = [
        feed_counts(feed).join(known, "ticker", "left_anti").select(F.lit(name).alias("feed"), "ticker", "n_rows")
        for name, feed in feeds.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def feed_counts(feed: DataFrame) -> DataFrame:
    """Rows received per ticker."""
    return feed.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"))
