from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from sessionvol import __main__ as command
from sessionvol import pipeline
from sessionvol.plans.layers import Layers
from sessionvol.session import new_folder


@pytest.fixture
def feeds(tmp_path):
    """Vendor files of two tickers of the universe; a third has metadata only."""
    def write(feed, ticker, header, rows):
        folder = tmp_path / "feeds" / feed / f"ticker={ticker}"
        folder.mkdir(parents=True)
        lines = [",".join(str(v) for v in row) for row in rows]
        (folder / "part.csv").write_text("\n".join([header, *lines]) + "\n")

    prices = "Open,High,Low,Close,Volume"
    start = datetime(2024, 1, 8, 9, 30)
    for ticker, cap in (("AAPL", 3.8e12), ("XOM", 5e9), ("O", "")):
        write("metadata", ticker, "longName,industry,marketCap,country,currency", [(f"{ticker} Inc", "I", cap, "", "")])
        if ticker == "O":
            continue
        write("intraday", ticker, f"Datetime,{prices}", [
            (f"{start + timedelta(days=d, minutes=5 * s)}-05:00", 1, 2, 1, 2, 100 + d * 10 + s)
            for d in range(4) for s in range(6)
        ])
        write("daily", ticker, f"Date,{prices}", [
            (date(2024, 1, 1) + timedelta(days=d), 1, 2, 1, 2 + d % 3, 1000) for d in range(12)
        ])
    return str(tmp_path / "feeds")


def test_from_vendor_files_to_marts(spark, feeds, tmp_path):
    out = str(tmp_path / "csv")
    reports = pipeline.ingest(spark, feeds, out, run_time="2024-02-02 03:04:05")
    assert {r.ticker: r.n_rows for r in reports["feed_counts"].collect()} == {"AAPL": 24, "XOM": 24}
    assert reports["missing_feeds"].count() == 53
    built = pipeline.build(spark, out, Layers(spark, prefix="pipe_", location=new_folder(spark, "pipe")))
    named = {r.ticker: r for r in built.table("staging", "stg_ticker_metadata").collect()}
    assert {t: (r.sector, r.market_cap_band, r.currency) for t, r in named.items()} == {
        "AAPL": ("Technology", "large", "USD"), "XOM": ("Energy", "mid", "USD"),
        "O": ("Real Estate", "unknown", "USD"),
    }
    curve = built.table("marts", "mart_volume_curve").orderBy("minutes_since_open").collect()
    assert [(r.minutes_since_open, r.sample_size) for r in curve] == [(5 * s, 8) for s in range(6)]
    regimes = built.table("marts", "mart_volume_curve_by_vol_regime")
    assert {r.vol_regime for r in regimes.collect()} <= {"high", "low"} and regimes.count() > 0


def test_command(spark, feeds, tmp_path, capsys):
    out = str(tmp_path / "csv")
    command.main(["ingest", feeds, out])
    assert "missing_feeds" in capsys.readouterr().out
    command.main(["build", out, "--prefix", "cmd_", "--location", new_folder(spark, "cmd")])
    assert "mart_volume_curve_by_sector" in capsys.readouterr().out


def test_header_only_feed(spark, feeds, tmp_path):
    """A daily feed without rows: the dataset is reported, its tables are empty, the rest is built."""
    for folder in (tmp_path / "feeds" / "daily").iterdir():
        (folder / "part.csv").write_text("Date,Open,High,Low,Close,Volume\n")
    out = str(tmp_path / "csv")
    reports = pipeline.ingest(spark, feeds, out, run_time="2024-02-02 03:04:05")
    assert [r.relation for r in reports["empty_datasets"].collect()] == ["daily_bars"]
    built = pipeline.build(spark, out, Layers(spark, prefix="none_", location=new_folder(spark, "none")))
    assert built.table("staging", "stg_daily_bars").count() == 0
    assert built.table("marts", "mart_daily_volatility").count() == 0
    assert built.table("marts", "mart_volume_curve_by_vol_regime").count() == 0
    assert built.table("marts", "mart_volume_curve").count() == 6


def test_foreign_tickers_are_reported(spark, feeds, tmp_path):
    few = spark.createDataFrame([("AAPL", "Technology")], "ticker string, sector string")
    reports = pipeline.ingest(spark, feeds, str(tmp_path / "csv"), few, "2024-02-02 03:04:05")
    found = {(r.feed, r.ticker): r.n_rows for r in reports["foreign_tickers"].collect()}
    assert found == {("metadata", "XOM"): 1, ("metadata", "O"): 1, ("intraday", "XOM"): 24, ("daily", "XOM"): 12}
