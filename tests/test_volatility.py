from __future__ import annotations

import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

import sessionvol as sv
from sessionvol import session
from sessionvol.plans import ordered
from sessionvol.plans.ordered import block_window, ordered_blocks, own_rows


def expected_volatility(closes, least=1):
    """Brute force: [(return, volatility)] of one ticker's ordered closes."""
    returns = [None] + [b / a - 1 for a, b in zip(closes, closes[1:], strict=False)]
    found = []
    for i, current in enumerate(returns):
        frame = [r for r in returns[max(0, i - 19): i + 1] if r is not None]
        if frame and len(frame) >= least:
            found.append((current, statistics.pstdev(frame) * math.sqrt(252)))
    return found


def upper_median(values):
    return sorted(values)[len(values) // 2]


def random_closes(n, seed):
    rng = random.Random(seed)
    return [round(50 + 40 * rng.random(), 2) for _ in range(n)]


def test_first_and_second_day(days):
    assert sv.daily_volatility(days(("A", 0, 10.0))).count() == 0
    rows = sv.daily_volatility(days(("A", 0, 10.0), ("A", 1, 11.0))).collect()
    assert [(r.realized_vol_20d, r.vol_regime) for r in rows] == [(0.0, "low")]


def test_short_frames_need_min_periods(days):
    rows = [("A", i, 10.0 + i % 3) for i in range(5)]
    assert sv.daily_volatility(days(*rows), min_periods=20).count() == 0
    assert sv.daily_volatility(days(*rows), min_periods=3).count() == 2


def test_upper_median_decides(spark):
    df = spark.createDataFrame([("A", float(v)) for v in (1, 2, 3, 4)], "ticker string, realized_vol_20d double")
    assert sv.vol_threshold(df).first().vol_threshold == 3.0


@pytest.mark.parametrize("block_rows", [20, 33, 4096])
@pytest.mark.parametrize("least", [1, 20])
def test_against_brute_force(days, block_rows, least):
    series = {"A": random_closes(150, 1), "B": random_closes(90, 2), "C": random_closes(21, 3)}
    raw = days(*[(t, 3 * i, c) for t, closes in series.items() for i, c in enumerate(closes)])
    got = sv.daily_volatility(raw, min_periods=least, block_rows=block_rows)
    assert got.columns == ["ticker", "trade_date", "daily_return", "realized_vol_20d", "vol_regime"]
    for ticker, closes in series.items():
        rows = got.where(F.col("ticker") == ticker).orderBy("trade_date").collect()
        want = expected_volatility(closes, least)
        assert [r.realized_vol_20d for r in rows] == pytest.approx([v for _, v in want])
        limit = upper_median([r.realized_vol_20d for r in rows])
        assert [r.vol_regime for r in rows] == [
            "high" if r.realized_vol_20d > limit else "low" for r in rows
        ]


def test_raw_and_staged_days_agree(days):
    closes = random_closes(80, 5)
    raw = days(*[("A", i, c, 0 if i % 7 == 0 else 10) for i, c in enumerate(closes)])
    from_raw = sv.daily_volatility(raw).orderBy("trade_date").collect()
    from_staged = sv.daily_volatility(sv.stg_daily_bars(raw)).orderBy("trade_date").collect()
    assert from_raw == from_staged


def test_share_of_high_days(days):
    raw = days(*[(t, i, c) for t in "ABC" for i, c in enumerate(random_closes(31, ord(t)))])
    counts = sv.daily_volatility(raw).groupBy("ticker").agg(
        F.count("*").alias("n"), F.count_if(F.col("vol_regime") == "high").alias("high")
    ).collect()
    assert all(r.high == (r.n - 1) // 2 for r in counts)


def test_a_day_without_date_is_kept(days):
    raw = days(("A", 0, 10.0), ("A", 1, 11.0)).withColumn(
        "trade_date", F.when(F.col("close") > 10, F.col("trade_date"))
    )
    rows = sv.stg_daily_bars(raw).orderBy("trade_date").collect()
    assert [(r.close, r.daily_return) for r in rows] == [(10.0, None), (11.0, pytest.approx(0.1))]


def test_several_loads_of_a_day_are_all_kept(days):
    raw = days(*[("A", i, c) for i, c in enumerate(random_closes(50, 9))] * 3)
    staged = sv.stg_daily_bars(raw)
    assert staged.count() == 150
    assert staged.where("daily_return = 0").count() == 100


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    sizes=st.lists(st.integers(1, 60), min_size=1, max_size=4),
    block=st.integers(3, 25),
    lookback=st.integers(1, 3),
)
def test_blocks_equal_a_plain_window(spark, sizes, block, lookback):
    rows = [(f"k{k}", i * 7 % 61, float(i * 37 % 101)) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    frame = (-lookback, 0)
    plain = df.withColumn("s", F.sum("x").over(Window.partitionBy("k").orderBy("t").rowsBetween(*frame)))
    blocks = ordered_blocks(df, "k", ["t"], lookback, block)
    cut = own_rows(blocks.withColumn("s", F.sum("x").over(block_window("k").rowsBetween(*frame))))
    order = ["k", "t"]
    assert cut.select(*plain.columns).orderBy(*order).collect() == plain.orderBy(*order).collect()


def test_blocks_are_bounded(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("r"), F.col("id") % 50)).otherwise("hot").alias("k"),
        F.col("id").alias("t"),
    )
    blocks = ordered_blocks(df, "k", ["t"], 20, 100)
    assert blocks.groupBy("k", "_block").count().agg(F.max("count")).first()[0] <= 120
    assert own_rows(blocks).count() == 10_000


def test_block_must_hold_the_lookback(spark):
    with pytest.raises(ValueError, match="block"):
        ordered_blocks(spark.range(1), "id", ["id"], 20, 10)


def test_days_without_a_ticker_are_kept(spark, days):
    raw = days(("A", 0, 10.0), ("A", 1, 11.0), ("B", 0, 5.0), ("B", 1, 6.0), (None, 0, 20.0), (None, 1, 30.0))
    staged = sv.stg_daily_bars(raw)
    assert staged.count() == 6
    assert staged.where("ticker is null").orderBy("trade_date").first().daily_return is None
    assert {r.daily_return for r in staged.where("ticker is null and trade_date > '2020-01-01'").collect()} == {0.5}
    rated = sv.daily_volatility(raw)
    assert rated.groupBy("ticker").count().count() == 3 and rated.where("ticker is null").count() == 1


def test_many_loads_of_one_day_and_many_days_without_date(spark, monkeypatch):
    """No task ranks them all: positions come from ranges, which split equal rows too."""
    n = F.col("id")
    days = spark.range(0, 200_000, 1, 16).select(
        F.lit("A").alias("ticker"),
        F.when(n % 2 == 0, F.lit("2024-01-01").cast("date")).alias("trade_date"),
        *[F.lit(2.0).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("bigint").alias("volume"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )
    # So small a shuffle would be put together again.
    stored = []
    keep = session.settle
    monkeypatch.setattr(ordered, "settle", lambda df: stored.append(keep(df)) or stored[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = ordered.ordered_blocks(days, "ticker", ["trade_date", "ingested_at", "close"], 20)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = stored[0].groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert files < 120_000
    assert blocks.groupBy("_block").count().agg(F.max("count")).first()[0] <= 4096 + 20
    own = own_rows(blocks.withColumn("p", F.col("_position")))
    assert own.agg(F.count("*"), F.countDistinct("p"), F.max("p")).first()[:] == (200_000, 200_000, 199_999)
