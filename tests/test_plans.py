"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import sessionvol as sv
from checks import fixtures, queries
from checks.compare import plan
from sessionvol.plans import ordered
from sessionvol.plans.joins import lookup_join, salts_for
from sessionvol.plans.ordered import ordered_blocks


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def normalized(spark, sf_dir):
    return queries.normalized(spark, sf_dir)


def test_bars_are_not_shuffled_to_be_normalised(normalized):
    text = plan(normalized)
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text


def test_scan_reads_only_needed_columns(normalized):
    text = plan(normalized.groupBy("sector").agg(F.avg("normalized_volume")))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    bars = next(s for s in scans if "bar_time" in s)
    assert {c.split(":")[0] for c in bars.split(",")} == {"ticker", "sector", "bar_time", "close", "volume"}
    assert "GreaterThan(volume,0)" in text and "GreaterThan(close,0.0)" in text


def test_sector_filter_reaches_the_scan(normalized):
    text = plan(normalized.where(F.col("sector").isin("S1", "S3")))
    assert "In(sector, [S1,S3])" in text


def test_unmatched_bars_make_an_inner_join(spark, sf_dir, normalized):
    joined = sv.bars_with_regime(normalized, queries.volatility(spark, sf_dir))
    assert "LeftOuter" not in optimized(joined).split("vol_regime")[0]


def test_rows_are_never_windowed_by_ticker_alone(spark, sf_dir):
    """Row-level windows run per (ticker, month) and (ticker, block)."""
    days = fixtures.raw(spark, sf_dir, "daily_bars")
    text = optimized(sv.realized_volatility(days))
    windows = re.findall(r"Window \[(.*?)\], \[(ticker#\d+(?:, _\w+#\d+L?)?)\]", text)
    by_ticker = [what for what, keys in windows if "," not in keys]
    assert windows and all("_rows" in what for what in by_ticker)


def test_volatility_stores_only_what_it_needs(spark, sf_dir, monkeypatch):
    days = fixtures.raw(spark, sf_dir, "daily_bars")
    stored = []
    keep = ordered.settle
    monkeypatch.setattr(ordered, "settle", lambda df: (stored.append(plan(df)), keep(df))[1])
    sv.realized_volatility(days)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", "".join(stored))
    assert sorted({c.split(":")[0] for s in scans for c in s.split(",")}) == [
        "close", "ingested_at", "ticker", "trade_date", "volume"
    ]


def test_positions_need_no_window_over_a_ticker(spark, sf_dir):
    days = fixtures.raw(spark, sf_dir, "daily_bars")
    blocks = ordered_blocks(days, "ticker", ["trade_date"], 1)
    assert "row_number" not in plan(blocks)


def test_filter_reaches_the_scan_however_large_the_lookup(spark, sf_dir, monkeypatch):
    """The same pushed filters and columns with a broadcast and with a salted join."""
    staged = sv.stg_intraday_bars(fixtures.raw(spark, sf_dir, "intraday_bars"))

    def scan() -> tuple[list[str], list[str]]:
        chosen = sv.normalized_volume(staged, averages, size).where(F.col("sector").isin("S1", "S3"))
        text = plan(chosen.select("sector", "minutes_since_open", "normalized_volume"))
        bars = next(part for part in text.split("\n\n") if "Scan parquet" in part and "bar_time" in part)
        return re.findall("In\\(sector[^)]*\\)", bars), sorted(re.findall("ReadSchema: .*", bars))

    averages, size = sv.avg_daily_volume(sv.daily_total_volume(staged)), 0
    small = scan()
    size = 1 << 40
    large = scan()
    assert small[0] and small == large


def test_salts_follow_the_size():
    assert [salts_for(n, 100) for n in (1, 101, 400, 10**9)] == [8, 8, 32, 256]


@pytest.mark.parametrize("adaptive, copies", [("true", 8), ("false", 256)])
def test_a_lookup_is_not_shuffled_more_often_the_larger_it_is(spark, adaptive, copies):
    """Not the square of its size is shuffled where adaptive execution splits hot keys."""
    left = spark.range(1_000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        joined = lookup_join(left, lookup, ["k"], size=1 << 40)
        last = re.search(r"explode\(sequence\(0, (\d+)", joined._jdf.queryExecution().analyzed().toString()).group(1)
        rows = joined.agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("found"), F.sum("x").alias("x")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert int(last) + 1 == copies
    assert rows == (1_000, 715, sum(2 * (n % 7) for n in range(1_000) if n % 7 < 5))


def test_curve_cells_are_combined_before_the_shuffle(normalized):
    totals = sv.daily_total_volume(normalized)
    assert "partial_sum" in plan(totals)
    approx = plan(sv.volume_curve(normalized, approx=True))
    assert "partial_percentile_approx" in approx
