"""The two steps from vendor files to marts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionvol.operators.metadata import feed_counts, foreign_tickers, missing_feeds
from sessionvol.plans.layers import Layers
from sessionvol.sources.feeds import (
    ingest_daily,
    ingest_intraday,
    ingest_metadata,
    instruments,
)
from sessionvol.sources.quarantine import read_feed_files
from sessionvol.sources.scans import read_csv
from sessionvol.sources.sinks import write_csv
from sessionvol.sources.universe import default_universe

_PRICES = {"open": "double", "high": "double", "low": "double", "close": "double", "volume": "bigint"}

# Feed -> columns of its files, which lie in folders named ticker=ABC, in any order.
FEEDS = {
    "metadata": {
        "longname": "string", "industry": "string", "marketcap": "double", "country": "string", "currency": "string",
    },
    "intraday": {"datetime": "string", **_PRICES},
    "daily": {"date": "string", **_PRICES},
}


def ingest(
    spark: SparkSession,
    feeds: str,
    out: str,
    universe: DataFrame | None = None,
    run_time: datetime | str | None = None,
) -> dict[str, DataFrame]:
    """Vendor files below ``feeds`` to the three raw CSV datasets below ``out``.

    A file that fails, by its header or a malformed line, is left out and reported (failed_feeds); the others go on.
    Returns reports: bars per ticker, failed files, tickers without any bar, tickers of bars and metadata that the universe lacks, and the
    datasets that were empty and so left no files.
    """
    universe = universe if universe is not None else default_universe(spark)
    read = {name: read_feed_files(spark, f"{feeds}/{name}", columns) for name, columns in FEEDS.items()}
    vendor = {name: rows for name, (rows, _) in read.items()}
    failed = [files.select(F.lit(name).alias("feed"), "*") for name, (_, files) in read.items()]
    metadata = ingest_metadata(vendor["metadata"], universe, run_time)
    known = instruments(universe, metadata)
    raw = {
        "ticker_metadata": metadata,
        "intraday_bars": ingest_intraday(vendor["intraday"], known, run_time),
        "daily_bars": ingest_daily(vendor["daily"], run_time),
    }
    empty = [relation for relation, df in raw.items() if not write_csv(df, f"{out}/{relation}", relation)]
    return {
        "feed_counts": feed_counts(vendor["intraday"]),
        "failed_feeds": reduce(DataFrame.union, failed),
        "missing_feeds": missing_feeds(universe, vendor["intraday"]),
        "foreign_tickers": foreign_tickers(universe, vendor),
        "empty_datasets": spark.createDataFrame([(relation,) for relation in empty], "relation string"),
    }


def build(spark: SparkSession, csv: str, layers: Layers | None = None) -> Layers:
    """The raw CSV datasets below ``csv`` to raw tables, staging and marts; a dataset without files is empty."""
    layers = layers or Layers(spark)
    layers.build({
        relation: read_csv(spark, relation, f"{csv}/{relation}", absent_is_empty=True)
        for relation in ("intraday_bars", "ticker_metadata", "daily_bars")
    })
    return layers
