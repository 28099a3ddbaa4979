"""Hard negatives against a search through all rows; the curve; and what the zone maps leave out."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from sessionvol.llm import negatives

VECTORS = "vec_id long, label int, embedding array<float>"


def by_hand(rows, every=100, positives=5, wanted=5, percent=80):
    part = [
        (k, i, l, [math.floor(256 * float(np.float32(x))) for x in v]) for k, (i, l, v) in enumerate(rows)
        if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda p: (-p[0], p[1] is None, p[1] or 0)
    out = []
    for k, i, l, v in part:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m, q) for q, j, m, w in part if q != k]
        for score, j, *_ in sorted((s for s in scored if s[2] == l), key=order)[:positives]:
            fits = sorted((s for s in scored if s[2] != l and percent * score <= 100 * s[0] <= 100 * score), key=order)[:wanted]
            out += [(i, j, rank, n[1], score, n[0]) for rank, n in enumerate(fits, 1)]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(seed, n, dims, spread=1.0, groups=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(max(groups, 1), dims)) * (1 if groups else 0)
    return [(k, int(draw.integers(0, 4)), (centres[draw.integers(0, len(centres))] + spread * draw.normal(size=dims)).round(3).tolist()) for k in range(n)]


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (5, 1)])
def test_curve_goes_from_cell_to_cell(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = [bytes(k) for k in negatives.hilbert(cells, bits)]
    assert len(set(keys)) == len(cells)
    along = cells[sorted(range(len(cells)), key=keys.__getitem__)].astype(int)
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("block, values, pack", [(256, 1 << 20, 256), (8, 64, 3)])
def test_negatives_by_hand(spark, monkeypatch, block, values, pack):
    for name, value in (("BLOCK_ROWS", block), ("GROUP_VALUES", values), ("PACK", pack), ("TOGETHER", 2)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(1, 420, 4)
    rows += [rows[100], rows[200], (None, 1, rows[0][2]), (None, 2, rows[0][2]), (-100, 1, rows[7][2]), (600, 2, rows[8][2][:2]), (700, 1, [])]
    rows += [(500, None, rows[0][2]), (800, 1, None), (900, 1, [1.0, None, 0.0, 0.0]), (1000, 1, [math.nan, 0.0, 0.0, 0.0]), (1100, 1, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(k, 3, [1.0, 1.0, 1.0, 1.0]) for k in range(2000, 2300)] + [(k, 2, [1.0, 1.0, 1.0, 0.5]) for k in range(2300, 2350)]  # copies of two vectors
    random.Random(4).shuffle(rows)
    got = found(negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(5)))
    assert got == by_hand(rows) and len(got) > 30


def test_far_blocks_are_not_read(spark):
    rows = vectors(2, 6000, 6, 0.05, groups=12)
    df = spark.createDataFrame(rows, VECTORS).repartition(6)
    negatives_of, tables = negatives.mine(df, "vec_id", "label", "embedding", 256.0, 100, 5, 5, 80, 4)
    assert found(negatives_of) == by_hand(rows)
    read = sum(bin(int.from_bytes(r["mask"], "big")).count("1") for c in ("positives", "negatives") for r in tables[c].collect())
    every = 2 * tables["candidates"].count() * tables["anchors"].count()
    assert read < every / 3  # clusters: most blocks are out of reach


def test_large_components_are_exact(spark):
    draw = random.Random(5)
    rows = [(k, k % 3, [draw.uniform(1e6, 3e6), draw.uniform(-1e6, 1e6)]) for k in range(0, 300)]
    assert found(negatives.hard_negatives(spark.createDataFrame(rows, VECTORS))) == by_hand(rows)
    rows = [(k, k % 2, [3e30, 1.0]) for k in range(0, 101)]
    got = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r["negative_score"] for r in got} == {2**63 - 1} and len(got) == 2 * 25


def test_vectors_of_nothing_and_clashing_columns(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(100, None, None), (None, 1, [1.0]), (200, 1, [])], VECTORS)).count() == 0
    rows = vectors(3, 250, 3)
    df = spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in rows], VECTORS + ", id string, grp int, key string, block int, vec string")
    assert found(negatives.hard_negatives(df)) == by_hand(rows)
