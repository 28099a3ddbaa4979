from __future__ import annotations

import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sessionvol.plans import middle
from sessionvol.plans.middle import group_summaries, group_summary


def expected(values):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    if not known:
        return len(values), None, None, None, None
    n = len(known)
    return len(values), statistics.fmean(known), statistics.pstdev(known), known[(n - 1) // 2], known[n // 2]


def check(spark, groups, **options):
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r for r in group_summary(df, ["k"], "x", **options).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        n, mean, deviation, lower, upper = expected(values)
        row = got[key]
        assert (row["rows"], row["lower"], row["upper"]) == (n, lower, upper), key
        assert row["mean"] == (None if mean is None else pytest.approx(mean, rel=1e-12, abs=1e-12))
        assert row["deviation"] == (None if deviation is None else pytest.approx(deviation, rel=1e-9, abs=1e-9))


GROUPS = {
    "odd": [3.0, 1.0, 2.0],
    "even": [4.0, 1.0, 3.0, 2.0],
    "one": [7.0],
    "same": [0.5] * 9,
    "near": [1 + i * 1e-12 for i in range(50)],
    "signs": [-5.0, -1e-300, 0.0, 1e-300, 5.0, -2.0],
    "null": [None, None],
    "some null": [None, 2.0, 4.0, None],
    "nan": [float("nan"), 1.0, 2.0],
    "wide": [10.0 ** e for e in range(-300, 300, 7)],
    "hot value": [1.0] * 40 + [2.0] * 3 + [1.01] * 41,
    None: [1.0, 2.0, 2.0, 9.0],
}


@pytest.mark.parametrize("sort_rows", [4_000_000, 3])
def test_exact(spark, sort_rows, monkeypatch):
    check(spark, {k: v for k, v in GROUPS.items() if k not in ("wide",)}, sort_rows=sort_rows)


def test_wide_range(spark):
    df = spark.createDataFrame([(v,) for v in GROUPS["wide"]], "x double").selectExpr("'a' as k", "x")
    row = group_summary(df, ["k"], "x").first()
    assert (row["lower"], row["upper"]) == expected(GROUPS["wide"])[3:]


def test_many_narrowing_passes(spark, monkeypatch):
    monkeypatch.setattr(middle, "CELLS", 3)
    rng = random.Random(4)
    groups = {f"g{i}": [1 + rng.random() * 1e-3 for _ in range(200 + i)] for i in range(4)}
    check(spark, groups, sort_rows=2)


def test_averages(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 9.0, None), ("a", 5.0, 4.0)], "k string, x double, y double")
    assert group_summary(df, ["k"], "x", averages=["y"]).first()["y"] == 3.0


def test_empty(spark):
    assert group_summary(spark.createDataFrame([], "k string, x double"), ["k"], "x").count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    groups=st.dictionaries(
        st.sampled_from("abc"),
        st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40),
        min_size=1,
    ),
    sort_rows=st.sampled_from([1, 5, 100]),
)
def test_any_values(spark, groups, sort_rows):
    check(spark, groups, sort_rows=sort_rows)


@pytest.mark.parametrize("sort_rows", [4_000_000, 4])
def test_several_key_sets_in_one_go(spark, sort_rows):
    rng = random.Random(8)
    rows = [
        (rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([0.0, -1.5, rng.gauss(0, 3), None]))
        for _ in range(700)
    ]
    rows += [("hot", 1, 1 + i * 1e-9) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, j int, x double")
    key_sets = [["k"], ["j"], ["k", "j"]]
    for keys, got in zip(key_sets, group_summaries(df, key_sets, "x", sort_rows=sort_rows), strict=True):
        groups = {}
        for k, j, x in rows:
            groups.setdefault(tuple({"k": k, "j": j}[key] for key in keys), []).append(x)
        got = {tuple(r[key] for key in keys): r for r in got.collect()}
        assert set(got) == set(groups)
        for key, values in groups.items():
            n, mean, deviation, lower, upper = expected(values)
            assert (got[key]["rows"], got[key]["lower"], got[key]["upper"]) == (n, lower, upper)
            assert got[key]["mean"] == pytest.approx(mean, rel=1e-12, abs=1e-12)
            assert got[key]["deviation"] == pytest.approx(deviation, rel=1e-9, abs=1e-12)
