"""Vendor files that fail are left out and named; the others go on."""

from __future__ import annotations

from pathlib import Path

import pytest

from checks import fixtures
from checks.compare import plan
from sessionvol import pipeline
from sessionvol.pipeline import FEEDS
from sessionvol.sources.quarantine import header_names, read_feed_files
from sessionvol.sources import quarantine

HEADER = "Datetime,Open,High,Low,Close,Volume\n"
ROW = "2024-01-10 09:30:00-05:00,1,2,1,2,5\n"


@pytest.fixture
def put(tmp_path):
    def write(ticker, text, name="f.csv", feed="intraday"):
        folder = tmp_path / feed / f"ticker={ticker}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)

    write.folder = str(tmp_path / "intraday")
    return write


def read(spark, put):
    rows, failed = read_feed_files(spark, put.folder, FEEDS["intraday"])
    return (
        sorted((tuple(r) for r in rows.select("ticker", "open", "close", "volume").collect()), key=str),
        {(r.file.rsplit("/", 1)[1], r.ticker): (r.reason, r.n_rows) for r in failed.collect()},
    )


def test_good_malformed_and_other_header(spark, put):
    put("GOOD", HEADER + ROW)
    put("NUMBER", HEADER + ROW + "2024-01-10 09:35:00-05:00,1,2,1,oops,5\n" + ROW)
    put("HEADER", "Datetime,Open,High,Low,Last,Volume\n" + ROW)
    assert read(spark, put) == ([("GOOD", 1.0, 2.0, 5)], {
        ("f.csv", "NUMBER"): ("malformed rows", 1), ("f.csv", "HEADER"): ("no column close", 0)
    })


def test_every_file_has_its_own_order(spark, put):
    put("007", '"(\'Datetime\', \'\')","(\'Volume\', \'B\')","(\'Open\', \'B\')",High,Low,Close,Extra\r\n2024-01-10 09:30:00,7,1.5,2,1,3,"x, y"\r\n')
    put("B", HEADER + ROW + "\n" + HEADER + "2024-01-10 09:35:00-05:00,,2,1,NaN,\n")
    rows, failed = read(spark, put)
    assert len(rows) == 3
    assert failed == {} and rows[0] == ("007", 1.5, 3.0, 7)


@pytest.mark.parametrize("line", [
    "2024-01-10 09:30:00,1,2,1,2\n", "2024-01-10 09:30:00,1,2,1,2,5,6\n", "yesterday,1,2,1,2,5\n", "2024-01-10 09:30:00,1,2,1,2,5.5\n", "x\n",
])
def test_lines_that_fail_a_file(spark, put, line):
    put("A", HEADER + ROW, "good.csv")
    put("A", HEADER + line + ROW + line, "bad.csv")
    assert read(spark, put) == ([("A", 1.0, 2.0, 5)], {("bad.csv", "A"): ("malformed rows", 2)})


def test_files_without_rows_and_only_failed_ones(spark, put):
    put("A", HEADER)
    put("B", "")
    assert read(spark, put) == ([], {})
    put("C", "a,b\n1,2\n")
    assert read(spark, put)[1] == {("f.csv", "C"): ("no column datetime, open, high, low, close, volume", 0), }


def test_a_large_file_is_read_in_parts(spark, put):
    put("A", HEADER + ROW * 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        rows, failed = read_feed_files(spark, put.folder, FEEDS["intraday"])
        assert quarantine._lines(spark, put.folder).rdd.getNumPartitions() > 4
        assert rows.count() == 20_000 and failed.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_opened_once(spark, put, monkeypatch):
    """One scan of the files, small ones many to a task, with the session's settings left as they were."""
    for number in range(200):
        put(f"T{number}", HEADER + ROW * (1 + number % 3) + ("?\n" if number == 7 else ""))
    stored, keep, former = [], quarantine.settle, spark.conf.getAll
    monkeypatch.setattr(quarantine, "settle", lambda df: (stored.append(plan(df)), keep(df))[1])
    rows, failed = read(spark, put)
    assert len(rows) == 397 and failed == {("f.csv", "T7"): ("malformed rows", 1)}
    assert sum("Scan text" in text for text in stored) == 1
    assert spark.conf.getAll == former


def test_vendor_files_come_alone(spark, sf_dir):
    """One file in the folder of each ticker, and nothing that a vendor doesn't send."""
    folder = Path(fixtures.vendor_files(spark, sf_dir).removeprefix("file:"))
    tickers = fixtures.raw(spark, sf_dir, "intraday_bars").select("ticker").distinct().count()
    sent = [p for p in folder.rglob("*") if p.is_file() and p.parent != folder]
    assert len(sent) == len({p.parent for p in sent}) == tickers


def test_header_names(spark):
    text = 'Date Time , "(\'Close\', \'A, B\')","Say ""x""",(\'OPEN\'; 2)'
    row = spark.createDataFrame([(text,)], "h string").select(header_names(quarantine.F.col("h")).alias("n")).first()
    assert row.n == ["date time", "close", 'say "x"', "('open'; 2)"]


def test_a_run_goes_on_without_the_failed_files(spark, put, tmp_path):
    for ticker in ("AAPL", "XOM"):
        put(ticker, "longName,industry,marketCap,country,currency\nX Inc,I,3e12,US,\n", feed="metadata")
        put(ticker, "Date,Open,High,Low,Close,Volume\n2024-01-10,1,2,1,2,5\n2024-01-11,1,2,1,3,5\n", feed="daily")
    put("AAPL", HEADER + ROW)
    put("XOM", HEADER + "2024-01-10 09:30:00-05:00,1,2,1,?,5\n")
    put("O", "longName,industry,country,currency\nO Inc,I,US,\n", feed="metadata")
    reports = pipeline.ingest(spark, str(tmp_path), str(tmp_path / "csv"), run_time="2024-02-02 03:04:05")
    failed = {(r.feed, r.ticker): r.reason for r in reports["failed_feeds"].collect()}
    assert failed == {("intraday", "XOM"): "malformed rows", ("metadata", "O"): "no column marketcap"}
    assert {r.ticker: r.n_rows for r in reports["feed_counts"].collect()} == {"AAPL": 1}
    assert {"XOM", "O"} <= {r.ticker for r in reports["missing_feeds"].collect()}
