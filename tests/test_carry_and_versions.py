"""Returns by border carry, marts that stay readable, merged loads, and sketched curves."""

from __future__ import annotations

import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import sessionvol as sv
from sessionvol.operators import curves, staging
from sessionvol.plans import ordered
from sessionvol.plans.layers import Layers
from sessionvol.schemas import DAILY_BARS, TICKER_METADATA
from sessionvol.session import new_folder


def day_rows(n, seed=1):
    """A hot ticker, days without a date or a ticker, several loads of a day, untraded days."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        ticker = draw.choice(["HOT"] * 4 + ["A", "B", None])
        day = None if draw.random() < 0.1 else date(2020, 1, 1) + timedelta(days=draw.randrange(400))
        close = float(draw.randint(1, 50)) if draw.random() > 0.05 else 0.0
        loaded = datetime(2024, 1, 1, 0, 0, draw.randrange(3))
        rows.append((ticker, day, 1.0, close + 1, 0.5, close, draw.choice([0, 10, 20]), loaded))
    return rows + rows[:20]


def first(x):
    return (x is not None, x or 0) if not isinstance(x, date) else (True, x)


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_returns_by_hand(spark, block_rows):
    rows = day_rows(900)
    days = spark.createDataFrame(rows, DAILY_BARS).repartition(5)
    got = sv.stg_daily_bars(days, block_rows)
    want, last = [], {}
    key = lambda r: (r[0] or "", r[0] is not None, r[1] is not None, r[1] or date.min, r[7], r[5], r[6], r[2], r[3], r[4])
    for r in sorted((r for r in rows if r[6] > 0 and r[5] > 0), key=key):
        want.append((r[0], r[1], r[5], r[6], r[5] / last[r[0]] - 1 if r[0] in last else None))
        last[r[0]] = r[5]
    found = [(r.ticker, r.trade_date, r.close, r.volume, r.daily_return) for r in got.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    view = spark.sql(staging.daily_sql("{days}"), days=days)
    assert sorted(map(repr, view.collect())) == sorted(map(repr, got.select(view.columns).collect()))


def test_days_are_read_once_and_no_key_fills_a_task(spark, monkeypatch):
    days = spark.createDataFrame([("HOT", None, 1.0, 1.0, 1.0, 1.0 + k % 7, 1, datetime(2024, 1, 1)) for k in range(20_000)], DAILY_BARS)
    folder = new_folder(spark, "days")
    days.repartition(8).write.parquet(folder)
    stored = []
    keep = ordered.settle
    monkeypatch.setattr(ordered, "settle", lambda df: (stored.append(df._jdf.queryExecution().toString()), keep(df))[1])
    got = sv.stg_daily_bars(spark.read.schema(DAILY_BARS).parquet(folder), block_rows=1000)
    plan = got._jdf.queryExecution().optimizedPlan().toString() + got._jdf.queryExecution().executedPlan().toString()
    assert len(stored) == 1 and folder.rsplit("/", 1)[1] not in plan and "Join" not in plan
    part = got.withColumn("_p", F.spark_partition_id()).groupBy("_p").agg(F.count(F.lit(1)).alias("count"), F.sum("daily_return"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sizes = [r["count"] for r in part.collect()]  # whole rows: Spark leaves out what is only counted
        assert sum(sizes) == 20_000 and max(sizes) <= 12_000 and len(sizes) >= 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sv.stg_daily_bars(spark.createDataFrame([], DAILY_BARS)).count() == 0


@pytest.fixture
def raw(bars, days, metadata):
    start = datetime(2020, 1, 1, 14, 30)
    rows = [(t, str(start + timedelta(days=d, minutes=5 * s)), 5 + (d + s + ord(t)) % 11) for t in "AB" for d in range(4) for s in range(3)]
    return {
        "intraday_bars": bars(*rows), "daily_bars": days(*[(t, d, 10.0 + (d * ord(t)) % 5) for t in "AB" for d in range(4)]),
        "ticker_metadata": metadata(("A", 1e9, "small", "2024-01-01")),
    }


def layers(spark, **options):
    return Layers(spark, prefix=f"v{uuid.uuid4().hex[:8]}_", location=new_folder(spark, "versions"), **options)


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_failed_build_leaves_the_former_marts(spark, raw, monkeypatch, buckets):
    built = layers(spark, buckets=buckets)
    built.build(raw)
    before = {m: sorted(map(repr, built.table("marts", m).collect())) for m in ("mart_normalized_volume", "mart_volume_curve_by_market_cap", "mart_volume_curve")}
    broken = curves.curve_by_cap

    def fails(df, **options):  # while its tasks write
        return broken(df, **options).withColumn("sample_size", F.raise_error(F.lit("stopped")).cast("bigint"))

    more = raw | {"intraday_bars": raw["intraday_bars"].withColumn("volume", F.col("volume") * 3)}
    monkeypatch.setattr(curves, "curve_by_cap", fails)
    with pytest.raises(Exception, match="stopped"):
        built.build(more)
    assert sorted(map(repr, built.table("marts", "mart_volume_curve_by_market_cap").collect())) == before["mart_volume_curve_by_market_cap"]
    tables = {t.name for t in spark.catalog.listTables(built.prefix + "marts")}
    assert not [t for t in tables if "__" in t]
    monkeypatch.undo()
    built.build(more)
    assert sorted(map(repr, built.table("marts", "mart_normalized_volume").collect())) != before["mart_normalized_volume"]


def test_readers_of_the_former_version_go_on(spark, raw):
    built = layers(spark)
    built.build(raw)
    reader = built.table("marts", "mart_normalized_volume")
    rows = sorted(map(repr, reader.collect()))
    files = set(reader.inputFiles())
    built.build(raw | {"intraday_bars": raw["intraday_bars"].withColumn("volume", F.col("volume") + F.minute("bar_time"))})
    assert files.isdisjoint(built.table("marts", "mart_normalized_volume").inputFiles())
    assert sorted(map(repr, spark.read.parquet(*files).select(reader.columns).collect())) == rows
    built.build(raw)  # two builds later the first version is gone
    with pytest.raises(Exception, match="(?i)path|exist"):
        spark.read.parquet(*files).collect()


def test_merged_loads(spark, days):
    built = layers(spark, partitions=4)
    built.create_databases()
    many = lambda lo, hi, close: days(*[(f"T{t:02}", d, close, 1 + t) for t in range(20) for d in range(lo, hi)])
    built.load_raw("daily_bars", many(0, 500, 1.0), "merge")
    files = set(built.spark.table(built.name("raw", "daily_bars")).inputFiles())
    load = many(700, 740, 2.0).union(many(700, 740, 2.0).limit(3))  # of the year 2021, with three rows twice
    for _ in range(2):
        built.load_raw("daily_bars", load, "merge")
        assert built.raw("daily_bars").count() == 20 * 540 + 3
    now = set(built.spark.table(built.name("raw", "daily_bars")).inputFiles())
    untouched = {f for f in files if "trade_year=2020" in f}
    assert untouched and untouched <= now and not (files - untouched) & now
    of = spark.table(built.name("raw", "daily_bars")).where("trade_year = 2021").groupBy(F.input_file_name().alias("f")).agg(F.min("ticker").alias("a"), F.max("ticker").alias("b"))
    ranges = sorted((r.a, r.b) for r in of.collect())
    assert len(ranges) > 1 and all(x[1] <= y[0] for x, y in zip(ranges, ranges[1:]))  # one ticker, one or two files
    for _ in range(2):
        built.load_raw("ticker_metadata", spark.createDataFrame([("A", None, None, None, None, None, None, None, datetime(2024, 1, 1))], TICKER_METADATA), "merge")
    assert built.raw("ticker_metadata").count() == 1


def test_sketched_medians_of_large_groups(spark):
    n = F.col("id")
    bars = spark.range(400_000).select(
        F.concat(F.lit("S"), n % 3).alias("sector"), F.when(n % 5 == 0, "mid").otherwise("large").alias("market_cap_band"),
        F.lit(0).alias("minutes_since_open"), F.lit(14).alias("bar_hour"), F.lit(30).alias("bar_minute"),
        F.when(n % 1000 == 1, float("nan")).otherwise(F.pmod(F.xxhash64(n), F.lit(1_000_003)) / 1000.0).alias("normalized_volume"),
    )
    for curve, keys in zip(sv.curves_sketched(bars), ([], ["sector"], ["market_cap_band"])):
        exact = sv.volume_curve(bars, keys, median=False).withColumnsRenamed({"avg_normalized_volume": "mean", "stddev_normalized_volume": "sd"})
        for r in curve.join(exact.select(*keys, "mean", "sd"), keys or None, "cross" if not keys else "inner").collect():
            group = bars.where(" AND ".join(f"{k} = '{r[k]}'" for k in keys) or "true").where("NOT isnan(normalized_volume)")
            rank = group.agg(F.avg((F.col("normalized_volume") < r.median_normalized_volume).cast("int"))).first()[0]
            assert abs(rank - 0.5) < 0.005 and r.avg_normalized_volume == pytest.approx(r["mean"]) and r.stddev_normalized_volume == pytest.approx(r.sd)
            assert r.sample_size > 60_000
