"""Raw tables derived from the test tables, staged once per session and folder.

Bars come from ``events`` (one instrument per user, 5-minute buckets), days from
``events`` and ``orders``, metadata and the universe from ``customer``, so every relation
grows with the tables.  ``checks.oracle`` holds the same derivations as SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionvol.functions.values import cap_band
from sessionvol.operators.metadata import latest_metadata
from sessionvol.plans.joins import lookup_join
from sessionvol.schemas import DAILY_BARS, INTRADAY_BARS, TICKER_METADATA
from sessionvol.session import new_folder
from sessionvol.sources.feeds import feed_name
from sessionvol.sources.scans import read_raw
from sessionvol.sources.sinks import write_raw

LOADED_AT = "2024-02-01 00:00:00"


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _symbol(number: Column) -> Column:
    return F.concat(F.lit("T"), number.cast("string"))


def _sector(number: Column) -> Column:
    return F.concat(F.lit("S"), (number % 5).cast("string"))


def _wall(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve versions per ticker, one per customer; the last sixth of the users has none."""
    number = F.floor(F.col("c_custkey") / 12)
    cap = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") * 2e6)
    return source(spark, sf_dir, "customer").select(
        _symbol(number).alias("ticker"),
        F.col("c_name").alias("company_name"),
        _sector(number).alias("sector"),
        F.col("c_mktsegment").alias("industry"),
        cap.alias("market_cap"),
        cap_band(cap).alias("market_cap_band"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("country"),
        F.lit("USD").alias("currency"),
        F.timestamp_add("SECOND", F.col("c_custkey"), _wall("2024-01-01 00:00:00")).alias("fetched_at"),
    )


def metadata_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor records with fields missing here and there."""
    key = F.col("c_custkey")
    return source(spark, sf_dir, "customer").select(
        _symbol(key).alias("ticker"),
        F.when(key % 7 != 0, F.col("c_name")).alias("company_name"),
        F.when(key % 5 != 0, F.col("c_mktsegment")).alias("industry"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") * 2e6).alias("market_cap"),
        F.when(key % 3 != 0, F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))).alias("country"),
        F.when(key % 2 != 0, F.lit("EUR")).alias("currency"),
    )


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ninth more tickers than there are users: those have no feed."""
    number = F.floor(F.col("c_custkey") / 9)
    rows = source(spark, sf_dir, "customer")
    return rows.select(_symbol(number).alias("ticker"), _sector(number).alias("sector")).distinct()


def _prices(first: Column) -> list[Column]:
    value = F.col("value")
    return [
        F.min_by(value, first).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, first).alias("close"),
    ]


def _traded() -> Column:
    units = F.when(F.col("event_type") == "error", 0).otherwise(F.round(F.col("value") * 100))
    return F.sum(units.cast("bigint")).alias("volume")


def intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = (
        source(spark, sf_dir, "events")
        .groupBy("user_id", F.window("ts", "5 minutes").start.alias("bar_time"))
        .agg(*_prices(F.struct("ts", "event_id")), _traded())
        .withColumn("ticker", _symbol(F.col("user_id")))
        .withColumn("sector", _sector(F.col("user_id")))
    )
    bands = latest_metadata(metadata(spark, sf_dir)).select("ticker", "market_cap_band")
    return (
        lookup_join(bars, bands, ["ticker"])
        .withColumn("market_cap_band", F.coalesce("market_cap_band", F.lit("unknown")))
        .withColumn("interval", F.lit("5m"))
        .withColumn("ingested_at", _wall(LOADED_AT))
        .select(*INTRADAY_BARS.fieldNames())
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a user only has errors trade nothing."""
    return (
        source(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("trade_date"))
        .agg(*_prices(F.struct("ts", "event_id")), _traded())
        .withColumn("ticker", _symbol(F.col("user_id")))
        .withColumn("ingested_at", _wall(LOADED_AT))
        .select(*DAILY_BARS.fieldNames())
    )


def daily_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six and a half years of days: one ticker per hundred customers."""
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    return (
        source(spark, sf_dir, "orders")
        .groupBy(
            F.floor(F.col("o_custkey") / 100).alias("number"), F.to_date("o_orderdate").alias("trade_date")
        )
        .agg(
            F.min_by(price, key).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, key).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .withColumn("ticker", _symbol(F.col("number")))
        .withColumn("ingested_at", _wall(LOADED_AT))
        .select(*DAILY_BARS.fieldNames())
    )


# Staged relation -> (raw schema it has, derivation).
STAGED = {
    "intraday_bars": ("intraday_bars", intraday),
    "ticker_metadata": ("ticker_metadata", metadata),
    "daily_bars": ("daily_bars", daily),
    "daily_bars_long": ("daily_bars", daily_long),
}


_folders: dict[tuple[str, str, str], str] = {}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table in the layout of the raw layer, written on first use."""
    relation, derive = STAGED[name]
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _folders:
        _folders[key] = write_raw(derive(spark, sf_dir), relation, new_folder(spark, name))
    return read_raw(spark, relation, _folders[key])


def intraday_feeds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Vendor bars of even and odd users: New York and UTC offsets, vendor names."""
    bars = raw(spark, sf_dir, "intraday_bars")
    even = F.substring("ticker", 2, 20).cast("bigint") % 2 == 0
    feeds = []
    for own, shift, offset in ((even, -5, "-05:00"), (~even, 0, "+00:00")):
        local = F.timestamp_add("HOUR", F.lit(shift), F.col("bar_time"))
        feeds.append(
            bars.where(own).select(
                F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit(offset)).alias("Datetime"),
                F.col("ticker").alias("Ticker"),
                *[F.col(c).alias(f"('{c.title()}', 'X')") for c in ("open", "high", "low", "close", "volume")],
            )
        )
    return feeds


# Options of a write of very many small files: a local file system puts no checksum file beside each, as a vendor doesn't. Creating that one
# takes as long as the file itself. Other file systems don't know these options.
MANY_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def vendor_files(spark: SparkSession, sf_dir: str, broken: bool = False) -> str:
    """The intraday feeds as CSV files, one in the folder of each ticker; even and odd tickers order their columns differently.

    ``broken``: tickers 3, 10, 17, ... call their close by another name, and tickers 2, 7, 12, ... have no number in the closes of bars of half past.
    """
    rows = reduce(DataFrame.unionByName, intraday_feeds(spark, sf_dir))
    rows = rows.toDF(*[feed_name(c) for c in rows.columns])
    number = F.substring("ticker", 2, 20).cast("bigint")
    close = F.col("close").cast("string")
    if broken:
        close = F.when((number % 5 == 2) & F.col("datetime").contains(":30:00"), "n/a").otherwise(close)
    rows = rows.withColumn("close", close)
    last = F.when(F.lit(broken) & (number % 7 == 3), "Last").otherwise("Close")
    orders = (("datetime", "open", "high", "low", "close", "volume"), ("datetime", "close", "high", "low", "open", "volume"))
    line = [F.concat_ws(",", *[F.col(c).cast("string") for c in order]) for order in orders]
    header = [F.concat_ws(",", *[last if c == "close" else F.lit(c.title()) for c in order]) for order in orders]
    pick = lambda texts: F.when(number % 2 == 0, texts[0]).otherwise(texts[1]).alias("value")
    lines = rows.select("ticker", F.col("datetime").alias("k"), pick(line))
    heads = rows.select("ticker").distinct().select("ticker", F.lit("").alias("k"), pick(header))
    folder = new_folder(spark, "vendor")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = heads.union(lines).repartition(parts, "ticker").sortWithinPartitions("ticker", "k").drop("k")
    ready.write.options(**MANY_FILES).partitionBy("ticker").text(folder)
    return folder


def daily_feeds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    days = raw(spark, sf_dir, "daily_bars")
    even = F.substring("ticker", 2, 20).cast("bigint") % 2 == 0
    return [
        days.where(own).select(
            F.date_format("trade_date", pattern).alias("Date"),
            F.col("ticker").alias("Ticker"),
            *[F.col(c).alias(c.title()) for c in ("open", "high", "low", "close", "volume")],
        )
        for own, pattern in ((even, "yyyy-MM-dd"), (~even, "yyyy-MM-dd HH:mm:ss"))
    ]
