"""Run the registered queries against their SQL: python -m checks.compare [folder] [query ...]"""

from __future__ import annotations

import contextlib
import io
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import oracle, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plan(df: DataFrame) -> str:
    """The physical plan with pushed filters and read columns in full."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def _rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def differences(spark_df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Rows of the Spark result, and a few lines on what differs (none: equal)."""
    result = connection.sql(sql)
    want = _rows(result.columns, result.fetchall())
    got = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if want[0] != got[0]:
        return len(got[1]), [f"columns {got[0]} instead of {want[0]}"]
    surplus, absent = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    notes = [f"rows {len(got[1])} instead of {len(want[1])}"] if len(got[1]) != len(want[1]) else []
    if got[1] != want[1]:
        notes.append(f"{len(surplus)} surplus, {len(absent)} absent")
        notes += [f"+ {r}" for r in sorted(surplus)[:3]] + [f"- {r}" for r in sorted(absent)[:3]]
    kinds = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP",
    }
    types = dict(zip(result.columns, [str(t) for t in result.types], strict=True))
    notes += [
        f"{c} is {t}, {types[c]} in SQL" for c, t in spark_df.dtypes if kinds.get(t) != types[c]
    ]
    return len(got[1]), notes


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries.QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    registered, sql = queries.registered(), oracle.registered()
    for name in chosen:
        start = time.time()
        rows, notes = differences(registered[name](spark, sf_dir), connection, sql[name])
        failed += bool(notes)
        print(f"{'DIFF' if notes else 'ok  '} {name:30} {rows:8} rows {time.time() - start:6.2f} s")
        for note in notes:
            print("     ", note[:600])
    return failed


if __name__ == "__main__":
    sys.exit(main())
