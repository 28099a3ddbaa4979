"""Registered queries: every operator over whole tables derived from the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sessionvol as sv
from checks import fixtures
from sessionvol.operators.curves import curves_in_one_build
from sessionvol.plans.layers import MARTS, Layers
from sessionvol.session import new_folder, settle
from sessionvol.operators.curves import SLOT
from sessionvol.pipeline import FEEDS
from sessionvol.sources.feeds import (
    feed_name,
    ingest_daily,
    ingest_intraday,
    ingest_metadata,
    instruments,
    union_feeds,
)
from sessionvol.sources.quarantine import read_feed_files
from sessionvol.sources.scans import read_csv, read_raw
from sessionvol.sources.sinks import write_csv, write_raw

Query = Callable[[SparkSession, str], DataFrame]

RUN_TIME = "2024-02-02 03:04:05"
PRECISION = 7  # decimals of volatilities, before they are compared

# Decimals of columns whose last bits depend on the order of additions.
DECIMALS = {
    "avg_normalized_volume": 10,
    "median_normalized_volume": 10, "stddev_normalized_volume": 10, "upper_band": 10, "lower_band": 10,
    "avg_realized_vol": 9,
    "peak_normalized_volume": 8, "midday_trough": 8, "open_to_midday_ratio": 6,
    "large": 8, "mid": 8, "small": 8, "unknown": 8,
    "high_close": 8, "low_close": 8, "close_gap": 8, "close_ratio": 6,
    "open_spike": 6, "close_spike": 6,
}


# Volatilities have 7 decimals, so a mean of 8 or 16 of them may lie right between two roundings, where the last bit of a sum
# would decide; a little is added first, in the SQL too.
NUDGE = {"avg_realized_vol": 1e-11}


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + NUDGE.get(c, 0.0), DECIMALS[c]) for c in df.columns if c in DECIMALS})


def _raw(name: str) -> Query:
    return lambda spark, sf_dir: fixtures.raw(spark, sf_dir, name)


def staged(spark: SparkSession, sf_dir: str, session: sv.TradingSession = sv.UTC_SESSION) -> DataFrame:
    return sv.stg_intraday_bars(fixtures.raw(spark, sf_dir, "intraday_bars"), session)


def staged_at(spark: SparkSession, sf_dir: str, hours: int) -> DataFrame:
    """New York's session for bars moved by a number of hours: into summer, or over the change in March."""
    bars = fixtures.raw(spark, sf_dir, "intraday_bars")
    moved = bars.withColumn("bar_time", F.timestamp_add("HOUR", F.lit(hours), F.col("bar_time")))
    return sv.stg_intraday_bars(moved, sv.NEW_YORK_SESSION)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.normalized_volume(staged(spark, sf_dir))


def volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.daily_volatility(fixtures.raw(spark, sf_dir, "daily_bars"), precision=PRECISION)


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.daily_total_volume(staged(spark, sf_dir))


def threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fixtures.raw(spark, sf_dir, "daily_bars")
    return sv.vol_threshold(settle(sv.realized_volatility(days, precision=PRECISION)))


def volatility_long(min_periods: int) -> Query:
    return lambda spark, sf_dir: sv.daily_volatility(
        fixtures.raw(spark, sf_dir, "daily_bars_long"), min_periods=min_periods, precision=PRECISION
    )


def regime_curve(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return sv.curve_by_regime(normalized(spark, sf_dir), volatility(spark, sf_dir), **options)


def sector_curve(spark: SparkSession, sf_dir: str, sectors: list[str] | None = None, **options) -> DataFrame:
    return sv.curve_by_sector(normalized(spark, sf_dir), sectors, **options)


def all_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three curves that share their passes, under each other."""
    overall, by_sector, by_cap = sv.curves_together(normalized(spark, sf_dir))
    named = [
        overall.drop("upper_band", "lower_band").withColumn("grouping", F.lit("all")),
        by_sector.withColumnRenamed("sector", "grouping"),
        by_cap.withColumnRenamed("market_cap_band", "grouping"),
    ]
    return reduce(DataFrame.unionByName, named)


def four_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four curves of one build, under each other."""
    overall, by_sector, by_cap, by_regime = curves_in_one_build(normalized(spark, sf_dir), volatility(spark, sf_dir))
    named = [
        by_regime.withColumnRenamed("vol_regime", "grouping"),
        overall.drop("upper_band", "lower_band").withColumn("grouping", F.lit("all")),
        by_sector.withColumnRenamed("sector", "grouping"),
        by_cap.withColumnRenamed("market_cap_band", "grouping"),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def sketched_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three curves with sketched medians; of these, whether the exact rank is within a hundredth of the middle."""
    bars = normalized(spark, sf_dir)
    groupings = (("all", F.lit("all")), ("sector", F.col("sector")), ("market_cap_band", F.col("market_cap_band")))
    checked = []
    for (name, grouping), curve in zip(groupings, sv.curves_sketched(bars), strict=True):
        curve = settle(curve.withColumn("grouping", grouping).drop("upper_band", "lower_band", *([name] if name != "all" else [])))
        value, middle = F.col("normalized_volume"), F.col("median_normalized_volume")
        ranked = bars.withColumn("grouping", grouping).select("grouping", *SLOT, "normalized_volume").join(F.broadcast(curve), ["grouping", *SLOT])
        share = lambda test: F.avg(F.when(test, 1.0).otherwise(0.0))
        ranks = ranked.groupBy("grouping", *SLOT).agg(((share(value < middle) <= 0.51) & (share(value <= middle) >= 0.49)).cast("int").alias("near_middle"))
        checked.append(curve.drop("median_normalized_volume").join(ranks, ["grouping", *SLOT]))
    return reduce(DataFrame.unionByName, checked)


def loaded_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw days in two loads that overlap, the second one twice, merged."""
    built = Layers(spark, prefix=f"sv_{uuid.uuid4().hex[:12]}_", location=new_folder(spark, "merged"))
    built.create_databases()
    days = fixtures.raw(spark, sf_dir, "daily_bars")
    number = F.substring("ticker", 2, 20).cast("bigint")
    built.load_raw("daily_bars", days.where(number % 3 < 2))
    for _ in range(2):
        built.load_raw("daily_bars", days.where(number % 3 > 0), mode="merge")
    return built.raw("daily_bars")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_sector = sv.curve_by_sector(normalized(spark, sf_dir), median=False)
    # A slot's mean over all bars is that over the sectors, weighted by their bars: the bars are read once.
    weighted = F.sum(F.col("avg_normalized_volume") * F.col("sample_size")) / F.sum("sample_size")
    by_sector = settle(by_sector)
    return sv.kpi_cards(by_sector.groupBy(*SLOT).agg(weighted.alias("avg_normalized_volume")), by_sector)


def cap_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fixtures.metadata_feed(spark, sf_dir)
    return sv.with_cap_band(feed).select("ticker", "market_cap", "market_cap_band")


def universe_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.universe_join(fixtures.universe(spark, sf_dir), fixtures.raw(spark, sf_dir, "ticker_metadata"))


def known_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruments(fixtures.universe(spark, sf_dir), fixtures.raw(spark, sf_dir, "ticker_metadata"))


def feeds_intraday(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    known = known_instruments(spark, sf_dir)
    return [ingest_intraday(f, known, RUN_TIME) for f in fixtures.intraday_feeds(spark, sf_dir)]


def new_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_metadata(
        fixtures.metadata_feed(spark, sf_dir), fixtures.universe(spark, sf_dir), RUN_TIME
    )


def union_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_feeds(feeds_intraday(spark, sf_dir), "intraday_bars")


def union_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = [ingest_daily(f, RUN_TIME) for f in fixtures.daily_feeds(spark, sf_dir)]
    return union_feeds(feeds, "daily_bars")


def one_intraday_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds' bars under each other as the vendor names them, ingested at once."""
    feeds = [f.toDF(*[feed_name(c) for c in f.columns]) for f in fixtures.intraday_feeds(spark, sf_dir)]
    return ingest_intraday(reduce(DataFrame.unionByName, feeds), known_instruments(spark, sf_dir), RUN_TIME)


def csv_feed(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """The feed as vendor CSV files, one folder per ticker, ingested; failed files are left out."""
    rows, _ = read_feed_files(spark, fixtures.vendor_files(spark, sf_dir, broken), FEEDS["intraday"])
    return ingest_intraday(rows, known_instruments(spark, sf_dir), RUN_TIME)


def failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failed ones of the vendor files, named by their folder."""
    _, found = read_feed_files(spark, fixtures.vendor_files(spark, sf_dir, broken=True), FEEDS["intraday"])
    return found.withColumn("file", F.regexp_replace("file", "^.*/(ticker=[^/]*)/[^/]*$", "$1"))


def foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = {"metadata": fixtures.metadata_feed(spark, sf_dir), "daily": fixtures.raw(spark, sf_dir, "daily_bars")}
    return sv.foreign_tickers(fixtures.universe(spark, sf_dir), feeds)


def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.missing_feeds(fixtures.universe(spark, sf_dir), fixtures.raw(spark, sf_dir, "intraday_bars"))


def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = fixtures.raw(spark, sf_dir, "intraday_bars")
    folder = write_raw(bars, "intraday_bars", new_folder(spark, "roundtrip"))
    return spark.read.parquet(folder)


def bounded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = fixtures.raw(spark, sf_dir, "intraday_bars")
    folder = write_raw(bars, "intraday_bars", new_folder(spark, "bounded"))
    return read_raw(spark, "intraday_bars", folder, start="2024-01-10 00:00:00", end="2024-01-20 12:00:00")


def csv_roundtrip(relation: str, shift: str | None = None) -> Query:
    """``shift`` adds microseconds to that column, so that fractions are seen to stay."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "csv")
        rows = fixtures.raw(spark, sf_dir, relation)
        if shift:
            rows = rows.withColumn(shift, F.timestamp_add("MICROSECOND", F.lit(250_001), F.col(shift)))
        write_csv(rows, f"{folder}/{relation}", relation)
        return read_csv(spark, relation, f"{folder}/{relation}")

    return run


# Relation -> number that is added up in the report of ``layers``.
CHECKSUM = {
    "intraday_bars": "volume", "ticker_metadata": "length(company_name)", "daily_bars": "volume",
    "stg_intraday_bars": "minutes_since_open", "stg_daily_bars": "daily_return",
    "stg_ticker_metadata": "length(company_name)",
    "mart_normalized_volume": "normalized_volume", "mart_daily_volatility": "realized_vol_20d",
    "mart_volume_curve": "median_normalized_volume",
    "mart_volume_curve_by_sector": "median_normalized_volume",
    "mart_volume_curve_by_market_cap": "stddev_normalized_volume",
    "mart_volume_curve_by_vol_regime": "avg_realized_vol",
}
STAGING = ("stg_intraday_bars", "stg_daily_bars", "stg_ticker_metadata")
RAW = ("intraday_bars", "ticker_metadata", "daily_bars")


def build_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """All layers in databases of their own."""
    built = Layers(
        spark, prefix=f"sv_{uuid.uuid4().hex[:12]}_", location=new_folder(spark, "layers"), precision=PRECISION
    )
    built.build({name: fixtures.raw(spark, sf_dir, name) for name in RAW})
    return built


_built: dict[tuple[str, str], Layers] = {}


def built_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers built once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build_layers(spark, sf_dir)
    return _built[key]


def mart(name: str) -> Query:
    """A stored mart."""
    return lambda spark, sf_dir: built_layers(spark, sf_dir).table("marts", name)


def build_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the build of the layers has counted while it wrote them."""
    return built_layers(spark, sf_dir).checks()


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build all layers in databases of their own, report rows and a sum per relation."""
    built = build_layers(spark, sf_dir)
    report = []
    for layer, relations in (("raw", RAW), ("staging", STAGING), ("marts", tuple(MARTS))):
        for relation in relations:
            total = F.sum(F.expr(CHECKSUM[relation]).cast("double"))
            counted = built.table(layer, relation).agg(
                F.count(F.lit(1)).alias("n_rows"), F.round(total, 4).alias("checksum")
            )
            report.append(counted.select(
                F.lit(layer).alias("layer"), F.lit(relation).alias("relation"), "n_rows", "checksum"
            ))
    return reduce(DataFrame.unionByName, report)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.quality_checks({
        "raw_intraday_bars": fixtures.raw(spark, sf_dir, "intraday_bars"),
        "stg_intraday_bars": staged(spark, sf_dir),
        "raw_daily_bars": fixtures.raw(spark, sf_dir, "daily_bars"),
        "stg_ticker_metadata": sv.stg_ticker_metadata(fixtures.raw(spark, sf_dir, "ticker_metadata")),
        "mart_daily_volatility": volatility(spark, sf_dir),
    })


QUERIES: dict[str, Query] = {
    "raw_intraday": _raw("intraday_bars"),
    "raw_daily": _raw("daily_bars"),
    "raw_metadata": _raw("ticker_metadata"),
    "stg_intraday": staged,
    "stg_intraday_strict": lambda s, d: staged(s, d, sv.TradingSession(strict_open=True)),
    "stg_intraday_new_york": lambda s, d: staged(s, d, sv.NEW_YORK_SESSION),
    "stg_daily": lambda s, d: sv.stg_daily_bars(fixtures.raw(s, d, "daily_bars")),
    "stg_metadata": lambda s, d: sv.stg_ticker_metadata(fixtures.raw(s, d, "ticker_metadata")),
    "daily_total_volume": totals,
    "avg_daily_volume": lambda s, d: sv.avg_daily_volume(totals(s, d)),
    "normalized_volume": normalized,
    "curve_overall": lambda s, d: sv.curve_overall(normalized(s, d)),
    "curve_by_sector": sector_curve,
    "curve_by_cap": lambda s, d: sv.curve_by_cap(normalized(s, d)),
    "curve_by_regime": regime_curve,
    "curves_together": all_curves,
    "curves_in_one_build": four_curves,
    "curves_sketched": sketched_curves,
    "merged_loads": loaded_twice,
    "vol_threshold": threshold,
    "daily_volatility": volatility,
    "daily_volatility_long": volatility_long(1),
    "daily_volatility_full_frames": volatility_long(20),
    "cap_band": cap_bands,
    "metadata_defaults": lambda s, d: sv.with_metadata_defaults(fixtures.metadata_feed(s, d)),
    "latest_metadata": lambda s, d: sv.latest_metadata(fixtures.raw(s, d, "ticker_metadata")),
    "universe_join": universe_metadata,
    "missing_feeds": missing,
    "feed_counts": lambda s, d: sv.feed_counts(fixtures.raw(s, d, "intraday_bars")),
    "union_feeds": union_intraday,
    "ingest_intraday": one_intraday_feed,
    "ingest_csv": csv_feed,
    "ingest_beside_failed": lambda s, d: csv_feed(s, d, broken=True),
    "failed_feeds": failed,
    "foreign_tickers": foreign,
    "ingest_daily": union_daily,
    "ingest_metadata": new_metadata,
    "sink_roundtrip": roundtrip,
    "sink_csv": csv_roundtrip("daily_bars"),
    "sink_csv_bars": csv_roundtrip("intraday_bars", "bar_time"),
    "sink_csv_metadata": csv_roundtrip("ticker_metadata", "fetched_at"),
    "bounded_scan": bounded_scan,
    "layers": layers,
    **{name: mart(name) for name in MARTS},
    "curve_overall_approx": lambda s, d: sv.curve_overall(normalized(s, d), approx=True),
    "stg_intraday_summer": lambda s, d: staged_at(s, d, 4_000),
    "stg_intraday_change_days": lambda s, d: staged_at(s, d, 1_600),
    "kpi_cards": cards,
    "curve_sector_subset": lambda s, d: sector_curve(s, d, ["S1", "S3"]),
    "curve_cap_pivot": lambda s, d: sv.curve_cap_pivot(sv.curve_by_cap(normalized(s, d), median=False)),
    "regime_close_gap": lambda s, d: sv.regime_close_gap(regime_curve(s, d, median=False)),
    "sector_spikes": lambda s, d: sv.sector_spikes(sector_curve(s, d, median=False)),
    "quality_checks": quality,
    "build_checks": build_checks,
}


def registered() -> dict[str, Query]:
    def run(query: Query) -> Query:
        return lambda spark, sf_dir: rounded(query(spark, sf_dir))

    return {name: run(query) for name, query in QUERIES.items()}
