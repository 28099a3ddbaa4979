"""One ticker, slot, value or load holding a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import sessionvol as sv
from sessionvol.plans.joins import lookup_join
from sessionvol.schemas import INTRADAY_BARS


@pytest.fixture(scope="module")
def skewed(spark):
    """300,000 bars; a third belongs to ticker T0, a third of those to one slot and value."""
    n = F.col("id")
    hot = n % 3 == 0
    start = F.lit("2024-01-01 14:30:00").cast("timestamp_ntz")
    slot = F.when(hot & (n % 9 == 0), 0).otherwise(F.floor(n / 3) % 78)
    df = spark.range(300_000).select(
        F.when(hot, "T0").otherwise(F.concat(F.lit("T"), n % 400)).alias("ticker"),
        F.when(hot, "S0").otherwise(F.concat(F.lit("S"), n % 5)).alias("sector"),
        F.lit("large").alias("market_cap_band"),
        F.timestamp_add("MINUTE", slot * 5 + F.floor(n / 3000) % 60 * 1440, start).alias("bar_time"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")],
        F.when(hot & (n % 9 == 0), 500).otherwise(1 + n * 7919 % 10007).alias("volume"),
        F.lit("5m").alias("interval"),
        start.alias("ingested_at"),
    )
    return df.select(*[F.col(f.name).cast(f.dataType) for f in INTRADAY_BARS])


@pytest.mark.parametrize("sort_rows", [4_000_000, 50])
def test_curves(skewed, sort_rows):
    bars = sv.normalized_volume(sv.stg_intraday_bars(skewed))
    for got, keys in (
        (sv.curve_overall(bars, sort_rows=sort_rows), ["minutes_since_open"]),
        (sv.curve_by_sector(bars, sort_rows=sort_rows), ["sector", "minutes_since_open"]),
    ):
        want = bars.groupBy(*keys).agg(
            F.count("*").alias("n"), F.median("normalized_volume").alias("median"),
            F.avg("normalized_volume").alias("mean"), F.stddev_pop("normalized_volume").alias("sd"),
        )
        both = got.join(want, keys)
        off = both.where(
            (F.col("n") != F.col("sample_size"))
            | (F.abs(F.col("median") - F.col("median_normalized_volume")) > 1e-15)
            | (F.abs(F.col("mean") - F.col("avg_normalized_volume")) > 1e-12)
            | (F.abs(F.col("sd") - F.col("stddev_normalized_volume")) > 1e-12)
        )
        assert both.count() == want.count() and off.count() == 0


def test_volatility_of_a_hot_ticker(spark):
    """A third of the days belong to one ticker: its blocks give what one window gives."""
    n = F.col("id")
    days = spark.range(60_000).select(
        F.when(n % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), n % 500)).alias("ticker"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.floor(n / 3).cast("int")).alias("trade_date"),
        *[(F.lit(50.0) + n * 7919 % 101).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("bigint").alias("volume"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )
    got = sv.daily_volatility(days, precision=9, block_rows=500)
    days.createOrReplaceTempView("skewed_days")
    want = spark.sql("""
        with r as (select ticker, trade_date,
            close / lag(close) over (partition by ticker order by trade_date) - 1 as daily_return
            from skewed_days),
          v as (select *, round(stddev_pop(daily_return) over (partition by ticker order by trade_date
            rows between 19 preceding and current row) * sqrt(252), 9) as realized_vol_20d from r),
          t as (select ticker, percentile_disc(0.5) within group (order by realized_vol_20d desc) as m
            from v group by ticker)
        select v.*, if(realized_vol_20d > m, 'high', 'low') as vol_regime from v join t using (ticker)
        where realized_vol_20d is not null""")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


@pytest.fixture
def without_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_key_is_spread_when_the_lookup_is_too_large_to_broadcast(spark, without_broadcast):
    n = F.col("id")
    left = spark.range(0, 200_000, 1, 8).select(
        F.when(n % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), n % 400)).alias("ticker"),
        F.sha2(n.cast("string"), 256).alias("payload"),
    )
    lookup = left.select("ticker").distinct().withColumn("x", F.length("ticker"))
    joined = lookup_join(left, lookup, ["ticker"], limit=0, salts=8)
    spread = joined.where("ticker = 'HOT'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in spread) == 66_667
    assert len(spread) >= 4 and max(r["count"] for r in spread) < 40_000

    # Even a grouping by the same key leaves adaptive execution free to split further.
    counted = joined.groupBy("ticker").agg(F.count("x").alias("n"), F.min("payload").alias("least"))
    got = {r.ticker: (r.n, r.least) for r in counted.collect()}
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    want = left.groupBy("ticker").agg(F.count("*").alias("n"), F.min("payload").alias("least")).collect()
    assert got == {r.ticker: (r.n, r.least) for r in want}
