from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sessionvol.pipeline import FEEDS
from sessionvol.plans.joins import lookup_join, measured_bytes
from sessionvol.schemas import DAILY_BARS, INTRADAY_BARS, TICKER_METADATA
from sessionvol.sources.feeds import (
    feed_name,
    ingest_daily,
    ingest_intraday,
    ingest_metadata,
    read_feed,
    union_feeds,
)
from sessionvol.sources.scans import read_csv, read_raw
from sessionvol.sources.sinks import clustered, write_csv, write_raw
from sessionvol.sources.universe import default_universe

RUN = datetime(2024, 2, 2, 3, 4, 5)


@pytest.fixture
def instruments(spark):
    return spark.createDataFrame([("A", "Tech", "mid")], "ticker string, sector string, market_cap_band string")


def vendor_bars(spark, name, texts):
    rows = [(t, 1.0, 3.0, 0.5, 2.0, 7) for t in texts]
    return spark.createDataFrame(
        rows, f"`{name}` string, Open double, High double, `('Low', 'A')` double, Close double, Volume bigint"
    )


def test_feed_names():
    assert [feed_name(n) for n in ("Datetime", "('Close', 'AAPL')", "(\"Volume\", \"A\")", " High ")] == [
        "datetime", "close", "volume", "high"
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_zoned_times_become_utc(spark, instruments, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        feed = vendor_bars(spark, "Datetime", [
            "2024-01-10 09:30:00-05:00", "2024-07-10 09:30:00-04:00", "2024-01-10 14:30:00+00:00",
            "2024-01-10 14:30:00", "2024-01-10T14:30:00Z",
        ])
        rows = ingest_intraday(feed, instruments, RUN, ticker="A").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    winter, summer = datetime(2024, 1, 10, 14, 30), datetime(2024, 7, 10, 13, 30)
    assert [r.bar_time for r in rows] == [winter, summer, winter, winter, winter]


def test_intraday_feed(spark, instruments):
    df = ingest_intraday(vendor_bars(spark, "Date", ["2024-01-10 14:30:00"]), instruments, RUN, ticker="A")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in INTRADAY_BARS]
    row = df.first()
    assert tuple(row) == ("A", "Tech", "mid", datetime(2024, 1, 10, 14, 30), 1.0, 3.0, 0.5, 2.0, 7, "5m", RUN)


def test_feed_of_an_unknown_instrument(spark, instruments):
    row = ingest_intraday(vendor_bars(spark, "Datetime", ["2024-01-10 14:30:00"]), instruments, RUN, ticker="Q").first()
    assert (row.sector, row.market_cap_band) == (None, "unknown")


def test_daily_feed(spark):
    feed = spark.createDataFrame(
        [("2024-01-10", 1.0, 2.0, 0.5, 1.5, 9)],
        "Date string, Open double, High double, Low double, Close double, Volume bigint",
    )
    df = ingest_daily(feed, RUN, ticker="A")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in DAILY_BARS]
    assert tuple(df.first()) == ("A", date(2024, 1, 10), 1.0, 2.0, 0.5, 1.5, 9, RUN)


def test_load_time_is_kept_or_now_in_seconds(spark):
    feed = spark.createDataFrame(
        [("2024-01-10", 1.0, 1.0, 1.0, 1.0, 9, "2023-01-01 00:00:00"), ("2024-01-11", 1.0, 1.0, 1.0, 1.0, 9, None)],
        "date string, open double, high double, low double, close double, volume bigint, ingested_at string",
    )
    rows = ingest_daily(feed, ticker="A").orderBy("trade_date").collect()
    assert rows[0].ingested_at == datetime(2023, 1, 1)
    assert rows[1].ingested_at > datetime(2024, 1, 1) and rows[1].ingested_at.microsecond == 0


def test_metadata_feed(spark):
    feed = spark.createDataFrame(
        [("A", None, None, 3e9, None, None)],
        "ticker string, company_name string, industry string, market_cap double, country string, currency string",
    )
    universe = spark.createDataFrame([("A", "Tech"), ("B", "Tech")], "ticker string, sector string")
    rows = [tuple(r) for r in ingest_metadata(feed, universe, RUN).collect()]
    assert rows == [("A", "", "Tech", "", 3e9, "mid", "", "USD", RUN)]


def test_union_matches_by_name(spark, bars):
    first = bars(("A", "2024-01-10 15:00:00", 1))
    second = bars(("B", "2024-01-10 15:00:00", 2)).select(*reversed(INTRADAY_BARS.fieldNames()))
    both = union_feeds([first, second], "intraday_bars")
    assert both.columns == INTRADAY_BARS.fieldNames()
    assert {(r.ticker, r.volume) for r in both.collect()} == {("A", 1), ("B", 2)}


def test_feed_folders_give_the_ticker(spark, instruments, tmp_path):
    for ticker in ("A", "Q"):
        (tmp_path / f"ticker={ticker}").mkdir()
        (tmp_path / f"ticker={ticker}" / "f.csv").write_text(
            "Datetime,Open,High,Low,Close,Volume\n2024-01-10 09:30:00-05:00,1,1,1,1,5\n"
        )
    df = ingest_intraday(read_feed(spark, str(tmp_path), FEEDS["intraday"]), instruments, RUN)
    assert {(r.ticker, r.bar_time.hour, r.market_cap_band) for r in df.collect()} == {
        ("A", 14, "mid"), ("Q", 14, "unknown")
    }


def test_csv_round_trip(spark, metadata, tmp_path):
    df = metadata(("A", 1e9, "small", "2024-01-01 10:11:12"), ("B", None, "unknown", "2024-01-01"))
    assert write_csv(df, str(tmp_path / "m"), "ticker_metadata")
    back = read_csv(spark, "ticker_metadata", str(tmp_path / "m"))
    assert sorted(back.collect()) == sorted(df.collect())
    text = "".join(p.read_text() for p in (tmp_path / "m").glob("*.csv"))
    assert text.splitlines()[0] == ",".join(TICKER_METADATA.fieldNames())
    assert "2024-01-01 10:11:12" in text


def test_empty_frame_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], DAILY_BARS)
    assert not write_csv(empty, str(tmp_path / "d"), "daily_bars")
    assert not (tmp_path / "d").exists()


def test_wrong_csv_header_is_an_error(spark, tmp_path):
    (tmp_path / "d.csv").write_text("ticker,trade_day,open,high,low,close,volume,ingested_at\nA,2024-01-01,1,1,1,1,1,\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, "daily_bars", str(tmp_path / "d.csv")).collect()


def test_bars_by_month(spark, bars, tmp_path):
    df = bars(*[("A", f"2024-{m:02}-10 15:00:00", m) for m in (1, 2, 3)], ("B", "2024-02-10 15:00:00", 9))
    folder = write_raw(df, "intraday_bars", str(tmp_path / "b"))
    assert sorted(p.name for p in (tmp_path / "b").glob("bar_month=*")) == [
        "bar_month=202401", "bar_month=202402", "bar_month=202403"
    ]
    got = read_raw(spark, "intraday_bars", folder)
    assert sorted(got.collect()) == sorted(df.collect())
    part = read_raw(spark, "intraday_bars", folder, start="2024-02-01", end="2024-03-01")
    assert sorted(r.volume for r in part.collect()) == [2, 9]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "bar_month" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_days_by_year(spark, days, tmp_path):
    df = days(("A", 0, 1.0), ("A", 400, 2.0))
    folder = write_raw(df, "daily_bars", str(tmp_path / "d"))
    assert sorted(p.name for p in (tmp_path / "d").glob("trade_year=*")) == ["trade_year=2020", "trade_year=2021"]
    assert sorted(read_raw(spark, "daily_bars", folder).collect()) == sorted(df.collect())
    assert read_raw(spark, "daily_bars", folder, start=date(2021, 1, 1)).count() == 1


def test_metadata_has_no_time_bounds(spark, metadata, tmp_path):
    folder = write_raw(metadata(("A", 1.0, "small", "2024-01-01")), "ticker_metadata", str(tmp_path / "m"))
    with pytest.raises(ValueError, match="bounds"):
        read_raw(spark, "ticker_metadata", folder, start="2024-01-01")


def test_clustered_splits_copies_and_keeps_order(spark):
    copies = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("t"), F.col("id") % 100)).otherwise("hot").alias("ticker"),
        F.lit(1).alias("t"),
    )
    parts = clustered(copies, ["ticker", "t"], 8).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 20_000
    assert parts.where("ticker = 'hot'").select("p").distinct().count() > 3


def test_lookup_join_beyond_the_limit(spark):
    left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    right = spark.range(5).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    small = lookup_join(left, right, ["k"])
    large = lookup_join(left, right, ["k"], limit=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert small.columns == large.columns
        assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_safe_lookup(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    for limit in (0, 1 << 20):
        got = lookup_join(left, right, ["k"], "inner", null_safe=True, limit=limit)
        assert sorted((r.x, r.y) for r in got.collect()) == [(1, 10), (2, 20)]
        assert got.columns == ["k", "x", "y"]


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n int")
    assert measured_bytes(df) == 2 * (16 + 16 + 16) + 3
    assert measured_bytes(df.where("n > 5")) == 0


def test_default_universe(spark):
    df = default_universe(spark)
    assert df.count() == 55
    assert {r["count"] for r in df.groupBy("sector").count().collect()} == {5}
    assert default_universe(spark, {"x": ["A", "B"]}).count() == 2


def vendor(folder, ticker, text):
    (folder / f"ticker={ticker}").mkdir()
    (folder / f"ticker={ticker}" / "f.csv").write_text(text)


def test_columns_are_found_by_name(spark, instruments, tmp_path):
    vendor(tmp_path, "A", "Datetime,Close,High,Low,Open,Volume\n2024-01-10 09:30:00-05:00,11,12,9,10,5\n")
    row = ingest_intraday(read_feed(spark, str(tmp_path), FEEDS["intraday"]), instruments, RUN).first()
    assert (row.open, row.high, row.low, row.close, row.volume) == (10, 12, 9, 11, 5)


def test_metadata_columns_are_found_by_name(spark, tmp_path):
    vendor(tmp_path, "A", "currency,sector,marketCap,country,longName,industry\nEUR,X,3e9,FR,A Inc,I\n")
    universe = spark.createDataFrame([("A", "S")], "ticker string, sector string")
    row = ingest_metadata(read_feed(spark, str(tmp_path), FEEDS["metadata"]), universe, RUN).first()
    assert (row.company_name, row.market_cap, row.country, row.currency, row.industry, row.sector) == ("A Inc", 3e9, "FR", "EUR", "I", "S")


def test_foreign_headers_are_errors(spark, tmp_path):
    vendor(tmp_path, "A", "Datetime,Open,High,Low,Last,Volume\n2024-01-10 09:30:00,1,1,1,1,1\n")
    with pytest.raises(ValueError, match="close"):
        read_feed(spark, str(tmp_path), FEEDS["intraday"])
    other = tmp_path / "mixed"
    other.mkdir()
    vendor(other, "A", "Datetime,Open,High,Low,Close,Volume\n2024-01-10 09:30:00,1,1,1,1,1\n")
    vendor(other, "B", "Datetime,Close,High,Low,Open,Volume\n2024-01-10 09:30:00,1,1,1,1,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_feed(spark, str(other), FEEDS["intraday"]).collect()


def test_csv_keeps_fractions_of_a_second(spark, bars, tmp_path):
    df = bars(("A", "2024-01-10 14:30:00.250", 1), ("A", "2024-01-10 14:35:00.000001", 1), ("A", "2024-01-10 14:40:00", 1))
    assert write_csv(df, str(tmp_path / "b"), "intraday_bars")
    assert sorted(read_csv(spark, "intraday_bars", str(tmp_path / "b")).collect()) == sorted(df.collect())
    old = tmp_path / "old"
    old.mkdir()
    (old / "f.csv").write_text(",".join(INTRADAY_BARS.fieldNames()) + "\nA,S,mid,2024-01-10 14:30:00,1,1,1,1,1,5m,2024-01-11 00:00:00\n")
    assert read_csv(spark, "intraday_bars", str(old)).first().bar_time.minute == 30


def test_absent_dataset(spark, tmp_path):
    assert read_csv(spark, "daily_bars", str(tmp_path / "none"), absent_is_empty=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, "daily_bars", str(tmp_path / "none"))
