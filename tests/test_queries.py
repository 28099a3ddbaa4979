"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry_points
from checks import oracle, queries
from checks.compare import connect, differences, plan

QUERIES = queries.registered()
SQL = oracle.registered()
NEVER = "Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin"


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, connection, name, monkeypatch):
    stored = []  # plans of what is stored on the way
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (stored.append(plan(w._df)), write(w, *a, **k))[1])
    df = QUERIES[name](spark, sf_dir)
    rows, notes = differences(df, connection, SQL[name])
    assert notes == []
    assert rows > 0
    assert not any(re.search(NEVER, text) for text in (plan(df), *stored))


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
