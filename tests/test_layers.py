from __future__ import annotations

import subprocess
import sys
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import sessionvol as sv
from sessionvol.operators.curves import bars_with_regime
from sessionvol.plans.layers import BY_HOUR, LAYERS, MARTS
from sessionvol.session import new_folder


def layers(spark, **options):
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    return sv.Layers(spark, prefix=prefix, location=new_folder(spark, "test_layers"), **options)


@pytest.fixture
def raw(bars, days, metadata):
    start = datetime(2020, 1, 1, 14, 30)
    rows = [
        (t, str(start + timedelta(days=d, minutes=5 * s)), 5 + (d * 7 + s * 3 + ord(t)) % 11)
        for t in "AB" for d in range(6) for s in range(4)
    ]
    return {
        "intraday_bars": bars(*rows),
        "daily_bars": days(*[(t, d, 10.0 + (d * ord(t)) % 5) for t in "AB" for d in range(6)]),
        "ticker_metadata": metadata(("A", 1e9, "small", "2024-01-01"), ("A", 3e9, "mid", "2024-01-02")),
    }


def test_database_names():
    assert sv.database_name(" marts ", "default") == "marts"
    assert sv.database_name(None, "default") == "default"
    assert sv.database_name("raw", "default", "dev_") == "dev_raw"


@pytest.mark.parametrize("buckets", [None, 4])
def test_build(spark, raw, buckets):
    built = layers(spark, buckets=buckets)
    built.build(raw)
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {built.prefix + layer for layer in LAYERS} <= names
    for relation, df in raw.items():
        assert sorted(built.raw(relation).collect(), key=str) == sorted(df.collect(), key=str)
    staged = sv.stg_intraday_bars(raw["intraday_bars"])
    view = built.table("staging", "stg_intraday_bars")
    assert view.dtypes == staged.dtypes
    assert sorted(view.collect()) == sorted(staged.collect())
    named = built.table("staging", "stg_ticker_metadata")
    assert named.collect() == sv.stg_ticker_metadata(raw["ticker_metadata"]).collect()
    days = built.table("staging", "stg_daily_bars")
    assert sorted(days.collect(), key=str) == sorted(sv.stg_daily_bars(raw["daily_bars"]).collect(), key=str)
    bars = sv.normalized_volume(staged)
    volatility = sv.daily_volatility(raw["daily_bars"])
    wanted = {
        "mart_normalized_volume": bars,
        "mart_daily_volatility": volatility,
        "mart_volume_curve": sv.curve_overall(bars),
        "mart_volume_curve_by_sector": sv.curve_by_sector(bars),
        "mart_volume_curve_by_market_cap": sv.curve_by_cap(bars),
        "mart_volume_curve_by_vol_regime": sv.curve_by_regime(bars, volatility),
    }
    assert set(wanted) == set(MARTS)
    for mart, df in wanted.items():
        got = built.table("marts", mart)
        assert got.columns == df.columns
        key = list(MARTS[mart])
        for a, b in zip(got.orderBy(*key).collect(), df.orderBy(*key).collect(), strict=True):
            # Sums of doubles differ in the last bits with the order of additions.
            for x, y in zip(a, b, strict=True):
                assert x == (pytest.approx(y, rel=1e-12) if isinstance(y, float) else y), mart


@pytest.mark.parametrize("buckets", [None, 4])
def test_build_counts_violations_while_it_writes(spark, raw, bars, days, monkeypatch, buckets):
    """The rows that a scan of every relation would give, also with rows that break rules, and on empty tables."""
    bad = bars(("A", "2020-01-01 15:00:00", -5), ("B", "2020-01-02 15:00:00", 0, 1.0, "S", "huge"), (None, "2020-01-02 15:05:00", None))
    raw = raw | {
        "intraday_bars": raw["intraday_bars"].unionByName(bad).unionByName(bad).repartition(5),
        "daily_bars": raw["daily_bars"].unionByName(days(("C", 1, -1.0), ("C", 2, None, -3))),
    }
    for given in (raw, {name: df.limit(0) for name, df in raw.items()}):
        built = layers(spark, buckets=buckets)
        counted = []
        with monkeypatch.context() as patched:
            # During the build nothing but the metadata is asked by a scan.
            patched.setattr("sessionvol.plans.layers.quality_checks", lambda found, session: counted.append(set(found)) or sv.quality_checks(found, session))
            got = built.build(given)
        assert counted == [{"stg_ticker_metadata"}]
        want = sv.quality_checks({
            "raw_intraday_bars": built.raw("intraday_bars"), "raw_daily_bars": built.raw("daily_bars"),
            "stg_intraday_bars": built.table("staging", "stg_intraday_bars"), "stg_ticker_metadata": built.table("staging", "stg_ticker_metadata"),
            "mart_daily_volatility": built.table("marts", "mart_daily_volatility"),
        })
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
        if given is raw:
            found = {(r.relation, r.rule): r.violations for r in got.collect()}
            assert found["raw_intraday_bars", "volume_not_negative"] == 4 and found["raw_intraday_bars", "known_cap_band"] == 2


def test_rebuild_replaces_and_append_adds(spark, raw):
    built = layers(spark)
    built.build(raw)
    n = built.table("marts", "mart_normalized_volume").count()
    built.build(raw)
    assert built.table("marts", "mart_normalized_volume").count() == n
    built.load_raw("daily_bars", raw["daily_bars"], mode="append")
    assert built.raw("daily_bars").count() == 2 * raw["daily_bars"].count()
    built.build_staging()
    assert built.table("staging", "stg_daily_bars").count() == 2 * raw["daily_bars"].count()


def test_raw_tables_stamp_the_load_time(spark, raw):
    built = layers(spark)
    built.create_databases()
    built.create_raw_tables()
    built.create_raw_tables()
    spark.sql(
        f"INSERT INTO {built.name('raw', 'ticker_metadata')} (ticker, market_cap) VALUES ('A', 1.0)"
    )
    row = built.raw("ticker_metadata").first()
    assert row.fetched_at > datetime(2024, 1, 1)
    built.load_raw("intraday_bars", raw["intraday_bars"], mode="append")
    assert built.raw("intraday_bars").count() == raw["intraday_bars"].count()
    columns = spark.catalog.listColumns(built.name("raw", "intraday_bars"))
    assert {c.name: c.description for c in columns}["bar_time"] == "start of the bar, UTC wall time"


def test_shared_buckets_join_without_a_shuffle(spark, raw):
    """Neither a shuffle, nor all bars of a hot ticker-day in one task."""
    start = "timestamp_ntz'2020-01-03 14:30:00'"
    hot = spark.range(100_000).selectExpr(
        "'A' ticker", "'S' sector", "'large' market_cap_band", f"{start} + make_dt_interval(0, 0, 0, pmod(id * 7, 23400)) bar_time",
        "1.0 open", "1.0 high", "1.0 low", "1.0 close", "1 + pmod(id, 9) volume", "'5m' `interval`", f"{start} ingested_at",
    )
    bars = raw["intraday_bars"]
    hot = hot.select(*[hot[f.name].cast(f.dataType).alias(f.name) for f in bars.schema.fields])
    built = layers(spark, buckets=16)
    built.build(raw | {"intraday_bars": bars.unionByName(hot)})
    by_hour = built.volatility_by_hour()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = bars_with_regime(built.table("marts", "mart_normalized_volume"), by_hour, size=1 << 50, salts=0)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Bars with a ticker and a day are joined where they lie; only those without are shuffled.
    assert plan.count("Bucketed: true") >= 2
    joins = plan.split("SortMergeJoin")
    assert "Exchange" not in joins[1].split("Union")[0]
    assert sum(tasks) >= 100_000 and max(tasks) < 60_000 and sum(n > 10_000 for n in tasks) >= 3


@pytest.mark.parametrize("options, limit", [({}, None), ({"buckets": 4}, -1)])
def test_four_curves_from_two_passes(spark, raw, bars, days, monkeypatch, options, limit):
    """Built together, also with bars of unrated days and without a ticker, the curves are those that are built one by one."""
    if limit is not None:
        monkeypatch.setattr("sessionvol.plans.layers.BROADCAST_BYTES", limit)
    odd = bars(("Z", "2020-01-01 15:00:00", 5), (None, "2020-01-02 15:00:00", 7), ("A", "2021-05-05 15:00:00", 3))
    frame = raw["intraday_bars"].unionByName(odd)
    built = layers(spark, together=True, **options)
    built.build(raw | {"intraday_bars": frame})
    shares, rated = sv.normalized_volume(sv.stg_intraday_bars(frame)), sv.daily_volatility(raw["daily_bars"])
    wanted = {
        "mart_volume_curve": sv.curve_overall(shares), "mart_volume_curve_by_sector": sv.curve_by_sector(shares),
        "mart_volume_curve_by_market_cap": sv.curve_by_cap(shares), "mart_volume_curve_by_vol_regime": sv.curve_by_regime(shares, rated),
    }
    for mart, df in wanted.items():
        got = built.table("marts", mart)
        assert got.columns == df.columns
        for x, y in zip(got.orderBy(*MARTS[mart]).collect(), df.orderBy(*MARTS[mart]).collect(), strict=True):
            assert tuple(x) == pytest.approx(tuple(y), rel=1e-9, abs=1e-12) if not isinstance(x[0], str) else (
                x[0] == y[0] and tuple(x[1:]) == pytest.approx(tuple(y[1:]), rel=1e-9, abs=1e-12)
            ), mart


@pytest.mark.parametrize("limit", [-1, None])
def test_regime_curve_in_shared_buckets(spark, raw, monkeypatch, limit):
    """Joined by the hour's rows or by a broadcast: the same curve."""
    if limit is not None:
        monkeypatch.setattr("sessionvol.plans.layers.BROADCAST_BYTES", limit)
    built = layers(spark, buckets=4)
    built.build(raw)
    assert spark.catalog.tableExists(built.name("marts", BY_HOUR)) == (limit is not None)
    want = sv.curve_by_regime(sv.normalized_volume(sv.stg_intraday_bars(raw["intraday_bars"])), sv.daily_volatility(raw["daily_bars"]))
    key = MARTS["mart_volume_curve_by_vol_regime"]
    got = built.table("marts", "mart_volume_curve_by_vol_regime").orderBy(*key).collect()
    assert got and [tuple(r[:2]) for r in got] == [tuple(r[:2]) for r in want.orderBy(*key).collect()]
    for a, b in zip(got, want.orderBy(*key).collect(), strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == (pytest.approx(y, rel=1e-12) if isinstance(y, float) else y)


def test_files_of_marts_are_sorted(spark, raw):
    built = layers(spark)
    built.build(raw)
    views = {row.viewName for row in spark.sql(f"SHOW VIEWS IN {built.prefix}staging").collect()}
    assert views == {"stg_intraday_bars", "stg_daily_bars", "stg_ticker_metadata"}
    for mart, order in MARTS.items():
        files = built.table("marts", mart).inputFiles()
        assert files
        for path in files:
            rows = [tuple(r[c] for c in order) for r in spark.read.parquet(path).collect()]
            assert rows == sorted(rows), mart


def test_stores_in_the_folder_that_the_session_names(tmp_path):
    """With spark.checkpoint.dir set, nothing is stored elsewhere."""
    script = f"""
from sessionvol.session import settle, spark_session
spark = spark_session("named", "local[1]", spark__checkpoint__dir="{tmp_path}")
print(settle(spark.range(5)).inputFiles()[0])
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=Path(__file__).parents[1], timeout=200)
    assert f"{tmp_path}/" in done.stdout and list(tmp_path.rglob("settled-*"))
