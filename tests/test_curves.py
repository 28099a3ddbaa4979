from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import sessionvol as sv
from sessionvol.operators import curves

CURVE = [
    "minutes_since_open", "bar_hour", "bar_minute", "sample_size", "avg_normalized_volume",
    "median_normalized_volume", "stddev_normalized_volume",
]


@pytest.fixture
def four(spark):
    rows = [(float(v), "S", "large", 0, 14, 30) for v in (1, 2, 3, 4)]
    return spark.createDataFrame(
        rows, "normalized_volume double, sector string, market_cap_band string, "
        "minutes_since_open bigint, bar_hour int, bar_minute int"
    )


def test_statistics(four):
    row = sv.curve_overall(four).first()
    assert row.sample_size == 4
    assert row.avg_normalized_volume == 2.5
    assert row.median_normalized_volume == 2.5
    assert row.stddev_normalized_volume == pytest.approx(1.118034, abs=1e-6)
    assert row.upper_band == pytest.approx(3.618034, abs=1e-6)
    assert row.lower_band == pytest.approx(1.381966, abs=1e-6)


def test_columns(four):
    assert sv.curve_overall(four).columns == [*CURVE, "upper_band", "lower_band"]
    assert sv.curve_by_sector(four).columns == ["sector", *CURVE]
    assert sv.curve_by_cap(four).columns == ["market_cap_band", *CURVE]


def test_approx_is_one_pass_and_close(four):
    row = sv.volume_curve(four, approx=True).first()
    assert row.sample_size == 4
    assert row.median_normalized_volume in (2.0, 3.0)


@pytest.fixture
def month(bars):
    """Twenty days of 5-minute bars of four tickers, one of them with most of the volume."""
    start = datetime(2024, 1, 1, 14, 30)
    rows = []
    for day in range(20):
        for slot in range(0, 78, 6):
            at = start + timedelta(days=day, minutes=5 * slot)
            for n, ticker in enumerate("ABCD"):
                volume = 10 + (day * 31 + slot * 17 + n * 7) % 50 + (10**6 if ticker == "A" else 0)
                rows.append((ticker, str(at), volume, 1.0 + day, f"S{n % 2}", "large" if n else "mid"))
    return bars(*rows)


def test_shares_of_a_ticker_add_up_to_its_days(month):
    sums = sv.normalized_volume(sv.stg_intraday_bars(month)).groupBy("ticker").agg(
        F.sum("normalized_volume").alias("total"), F.count_distinct("trade_date").alias("days")
    ).collect()
    assert [r.total for r in sums] == pytest.approx([r.days for r in sums])


def test_given_averages_are_used(spark, month):
    averages = spark.createDataFrame([("A", 2.0), ("B", 0.0)], "ticker string, avg_daily_volume double")
    got = sv.normalized_volume(sv.stg_intraday_bars(month), averages)
    assert got.where("ticker = 'A'").select(F.min(F.col("normalized_volume") * 2 - F.col("volume"))).first()[0] == 0
    assert got.where("ticker != 'A' and normalized_volume is not null").count() == 0


def test_curve_properties(month):
    bars = sv.normalized_volume(sv.stg_intraday_bars(month))
    overall = {r.minutes_since_open: r for r in sv.curve_overall(bars).collect()}
    assert sum(r.sample_size for r in overall.values()) == bars.count()
    assert all(r.lower_band <= r.avg_normalized_volume <= r.upper_band for r in overall.values())
    weighted = sv.curve_by_sector(bars).groupBy("minutes_since_open").agg(
        (F.sum(F.col("sample_size") * F.col("avg_normalized_volume")) / F.sum("sample_size")).alias("avg")
    ).collect()
    for row in weighted:
        assert row.avg == pytest.approx(overall[row.minutes_since_open].avg_normalized_volume)


def test_median_equals_the_built_in_one(month):
    bars = sv.normalized_volume(sv.stg_intraday_bars(month))
    want = {
        r.minutes_since_open: r.m
        for r in bars.groupBy("minutes_since_open").agg(F.median("normalized_volume").alias("m")).collect()
    }
    for row in sv.curve_overall(bars, sort_rows=5).collect():
        assert row.median_normalized_volume == pytest.approx(want[row.minutes_since_open], rel=1e-14)


def test_curves_together_equal_single_ones(month):
    bars = sv.normalized_volume(sv.stg_intraday_bars(month))
    single = (sv.curve_overall(bars), sv.curve_by_sector(bars), sv.curve_by_cap(bars))
    for one, other in zip(sv.curves_together(bars), single, strict=True):
        assert one.columns == other.columns
        key = one.columns[: one.columns.index("sample_size")]
        for a, b in zip(one.orderBy(*key).collect(), other.orderBy(*key).collect(), strict=True):
            assert a[: len(key) + 1] == b[: len(key) + 1]
            assert tuple(a[len(key):]) == pytest.approx(tuple(b[len(key):]), rel=1e-12)


def test_regime_curve_has_two_groups_and_no_unrated_bars(spark, month):
    bars = sv.normalized_volume(sv.stg_intraday_bars(month))
    rated = bars.select("ticker", "trade_date").distinct().where("day(trade_date) > 5").selectExpr(
        "ticker", "trade_date", "0.0D as daily_return", "day(trade_date) * 1.0D as realized_vol_20d",
        "if(day(trade_date) % 2 = 0, 'high', 'low') as vol_regime",
    )
    curve = sv.curve_by_regime(bars, rated, sort_rows=4)
    assert curve.columns == ["vol_regime", *CURVE, "avg_realized_vol"]
    rows = curve.collect()
    assert {r.vol_regime for r in rows} == {"high", "low"}
    assert sum(r.sample_size for r in rows) == bars.where("day(trade_date) > 5").count()
    joined = sv.bars_with_regime(bars, rated)
    want = {
        (r.vol_regime, r.minutes_since_open): (r.m, r.v)
        for r in joined.groupBy("vol_regime", "minutes_since_open").agg(
            F.median("normalized_volume").alias("m"), F.avg("realized_vol").alias("v")
        ).collect()
    }
    for r in rows:
        assert (r.median_normalized_volume, r.avg_realized_vol) == pytest.approx(
            want[r.vol_regime, r.minutes_since_open]
        )


@pytest.mark.parametrize("shared_buckets", [False, True])
def test_regime_curve_without_broadcast(spark, month, monkeypatch, shared_buckets):
    bars = sv.normalized_volume(sv.stg_intraday_bars(month))
    rated = bars.select("ticker", "trade_date").distinct().selectExpr(
        "ticker", "trade_date", "0.0D as daily_return", "day(trade_date) * 1.0D as realized_vol_20d",
        "if(day(trade_date) % 2 = 0, 'high', 'low') as vol_regime",
    )
    order = ["vol_regime", "minutes_since_open"]
    want = sv.curve_by_regime(bars, rated).orderBy(*order).collect()
    monkeypatch.setattr(curves, "measured_bytes", lambda df: 1 << 50)
    got = sv.curve_by_regime(bars, rated, shared_buckets=shared_buckets).orderBy(*order).collect()
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert tuple(a[5:]) == pytest.approx(tuple(b[5:]), rel=1e-12)


def test_sector_subset(month):
    bars = sv.normalized_volume(sv.stg_intraday_bars(month))
    assert {r.sector for r in sv.curve_by_sector(bars, ["S1"]).collect()} == {"S1"}


def curve(spark, rows, extra="sector string"):
    return spark.createDataFrame(
        rows, f"{extra}, minutes_since_open bigint, bar_hour int, bar_minute int, avg_normalized_volume double"
    )


def test_kpi_cards(spark):
    overall = curve(spark, [("-", 0, 14, 30, 0.9), ("-", 120, 16, 30, 0.1), ("-", 240, 18, 30, 0.2)])
    bars = spark.createDataFrame([("a",), ("b",), ("a",)], "sector string")
    row = sv.kpi_cards(overall, bars).first()
    assert (row.peak_normalized_volume, row.midday_trough, row.sector_count) == (0.9, 0.1, 2)
    assert row.open_to_midday_ratio == pytest.approx(6.0)
    without_open = sv.kpi_cards(overall.where("minutes_since_open > 0"), bars).first()
    assert without_open.open_to_midday_ratio is None


def test_cap_pivot(spark):
    df = curve(spark, [("large", 0, 14, 30, 0.9), ("mid", 0, 14, 30, 0.4)], "market_cap_band string")
    row = sv.curve_cap_pivot(df).first()
    assert (row.large, row.mid, row.small, row.unknown) == (0.9, 0.4, None, None)


def test_regime_close_gap(spark):
    df = curve(
        spark,
        [("high", 380, 20, 50, 9.0), ("high", 385, 20, 55, 0.6), ("low", 385, 20, 55, 0.4)],
        "vol_regime string",
    )
    row = sv.regime_close_gap(df).first()
    assert (row.close_minute, row.high_close, row.low_close) == (385, 0.6, 0.4)
    assert (row.close_gap, row.close_ratio) == pytest.approx((0.2, 1.5))


def test_sector_spikes(spark):
    df = curve(spark, [("a", 0, 14, 30, 3.0), ("a", 120, 16, 30, 1.0), ("a", 385, 20, 55, 2.0), ("b", 120, 16, 30, 1.0)])
    got = {r.sector: (r.open_spike, r.close_spike) for r in sv.sector_spikes(df).collect()}
    assert got == {"a": (1.5, 1.0), "b": (None, None)}


def test_quality_checks(bars, days):
    at = "2024-01-10 15:00:00"
    raw = bars(("A", at, 0), ("B", at, -1), ("C", at, 5, 1.0, "S", "huge"))
    got = {
        (r.relation, r.rule): (r.checked, r.violations)
        for r in sv.quality_checks({"raw_intraday_bars": raw, "raw_daily_bars": days(("A", 0, None))}).collect()
    }
    assert got == {
        ("raw_intraday_bars", "interval_is_5m"): (3, 0),
        ("raw_intraday_bars", "known_cap_band"): (3, 1),
        ("raw_intraday_bars", "volume_not_negative"): (3, 1),
        ("raw_intraday_bars", "volume_positive"): (3, 2),
        ("raw_daily_bars", "volume_not_negative"): (1, 0),
        ("raw_daily_bars", "close_positive"): (1, 1),
    }
