"""Operators with one right answer, against plain versions over all rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionvol.llm import benchmarks, kernels, lines, oracle, packing, quality, queries, repeats, tokens


def result(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# --- repeats


@pytest.mark.parametrize("window,minimiser", [(35, 5), (8, 3), (3, 1), (1, 1)])
def test_repeats(documents, rows, window, minimiser):
    got = repeats.remove_repeats(documents, window=window, minimiser=minimiser)
    want = Counter((r[0], *x) for r, x in zip(rows, plain.repeats([r[1] for r in rows], window)))
    assert result(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_repeats_hot_minimisers(spark, monkeypatch):
    """Windows that are dealt one by one give the same result."""
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [f"{' '.join(f'w{draw.randrange(10**6)}' for _ in range(20))} {passage} x{i} y{i}" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    found = repeats._pack
    monkeypatch.setattr(repeats, "_pack", lambda *a: (seen.append(len(a[-1])), found(*a))[1])
    monkeypatch.setattr(repeats, "HOT_LEAST", 50)
    got = repeats.remove_repeats(docs, window=12, minimiser=3)
    want = Counter((i, *x) for i, x in enumerate(plain.repeats(texts, 12)))
    assert result(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert seen[0] > 0


@pytest.mark.parametrize("most, forget", [(50_000, False), (3, False), (50_000, True)])
def test_repeats_heavy_windows(spark, monkeypatch, most, forget):
    """Windows at very many places: marked where they stand, all of them, a few, or beside others with the same hash."""
    draw = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(50))
    loop = "la la la " * 40
    texts = [f"{' '.join(f'w{draw.randrange(10**6)}' for _ in range(20))} {passage} x{i} y{i} {loop * (i % 3 == 0)}z{i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    found = repeats._pack

    def pack(window, minimiser, buckets, heavy, hot):
        seen.append(len(heavy))
        if forget:  # as if the words of every other one were those of another window with the same hash
            heavy = {x: b"other words" if i % 2 else w for i, (x, w) in enumerate(heavy.items())}
        return found(window, minimiser, buckets, heavy, hot)

    monkeypatch.setattr(repeats, "_pack", pack)
    monkeypatch.setattr(repeats, "HEAVY_LEAST", 20)
    monkeypatch.setattr(repeats, "HEAVY_MOST", most)
    got = repeats.remove_repeats(docs, window=12, minimiser=3)
    want = Counter((i, *x) for i, x in enumerate(plain.repeats(texts, 12)))
    assert result(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert 0 < seen[0] <= most


def test_repeats_equal_hashes(monkeypatch):
    """Windows whose hashes are equal by accident are told apart by their bytes."""
    flat = b"aa bb aa cc bb"
    lo, hi = np.array([0, 3, 6, 9, 12]), np.array([2, 5, 8, 11, 14])
    order, new = np.arange(5), np.array([True, False, False, False, False])
    marks = repeats._same(flat, lo, hi, order, new)
    groups = np.cumsum(marks) - 1
    texts = [flat[lo[i] : hi[i]] for i in order]
    assert [texts[i] == texts[j] for i in range(5) for j in range(5)] == [groups[i] == groups[j] for i in range(5) for j in range(5)]


# --- benchmark items


ITEMS = [(1, None), (2, ""), (3, "!!"), (4, "one"), (None, "De el fi"), (6, "berco " * 30)]


@pytest.mark.parametrize("block_bytes", [1 << 22, 400])
def test_benchmarks(spark, documents, rows, block_bytes):
    items = [*ITEMS, *((10 + k, " ".join(plain.words(rows[3 * k][1])[2:40]).upper()) for k in range(12)), (10, rows[8][1][:90])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = benchmarks.decontaminate(documents, table, block_bytes=block_bytes)
    want = Counter((r[0], *x) for r, x in zip(rows, plain.bench([r[1] for r in rows], items, 10)))
    assert result(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    kept = benchmarks.remove_passages(documents, table, block_bytes=block_bytes)
    assert kept.columns == documents.columns
    assert kept.count() == len(rows)
    found = plain.bench([r[1] for r in rows], items, 10)
    texts = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert Counter((r[0], r[1]) for r, x in zip(rows, found) if not x[1]) <= texts
    # Taking a passage out may put two halves of a short item together, but leaves no long one.
    long = [x for x in items if len(plain.bench_words(x[1])) >= 10]
    assert sum(x[1] for x in plain.bench([t for _, t in texts], long, 10)) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=0, max_size=14), min_size=1, max_size=5), st.text("abcd", max_size=40), st.integers(1, 5))
def test_automaton(items, text, window):
    spaced = [(str(i), " ".join(x)) for i, x in enumerate(items)]
    auto = benchmarks.Automaton(spaced, window)
    spans, hit = auto.stream([c.encode() for c in text])
    want = plain.bench([" ".join(text)], spaced, window)[0]
    covered = set()
    for lo, hi, _ in spans:
        covered |= set(range(lo, hi))
    assert (len(covered), len(hit)) == want[1:3]


# --- lines


@pytest.mark.parametrize("threshold,min_words", [(0.8, 5), (0.5, 2), (1.0, 5)])
def test_lines(documents, rows, threshold, min_words):
    got = lines.remove_lines(documents, threshold=threshold, min_words=min_words)
    assert got.columns == documents.columns
    want = plain.dedup_lines(rows, threshold, min_words)
    found = {}
    for r in got.collect():
        found.setdefault(r["doc_id"], set()).add(r["text"])
    for (i, text), kept in want.items():
        if any(plain.words(x) for x in kept.split("\n")) or not plain.words(text):
            assert (kept if text is not None else None) in found[i], i
        else:
            assert kept not in found.get(i, set())
    digest = lines.dedup_lines(documents, threshold=threshold, min_words=min_words)
    assert {(r["doc_id"], r["kept_sha256"]) for r in digest.collect()} == {(k[0], plain.sha(v)) for k, v in want.items()}


@pytest.mark.parametrize("often,candidates,close", [(1024, 2, 0.5), (4, 1, 64.0), (4, 1, 0.0)])
def test_lines_of_frequent_words(spark, monkeypatch, often, candidates, close):
    """All tokens are too frequent to be keys alone; classes whose first candidates fail get a second round."""
    monkeypatch.setattr(lines, "OFTEN", often)
    draw = random.Random(1)
    names = [f"t{i}" for i in range(14)]
    texts = ["\n".join(" ".join(draw.sample(names, draw.randint(1, 12))) for _ in range(6)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain.dedup_lines(list(enumerate(texts)), 0.8, 1)
    got = lines.dedup_lines(docs, min_words=1, candidates=candidates, close=close)
    assert {(r["doc_id"], r["kept_sha256"]) for r in got.collect()} == {(k[0], plain.sha(v)) for k, v in want.items()}


# --- packing


def test_tokens_are_the_tokenizers():
    enc = tokens.encoder(tokens.default_path())
    assert enc.fast
    draw = random.Random(2)
    alphabet = "abc DEF ÉéñÑüß 0123 .,!?'\"-\n\t  's 're 漢字 ​\x1c\x85\xa0ɏ😀 <|endoftext|>"
    for _ in range(400):
        text = "".join(draw.choices(alphabet, k=draw.randint(0, 60)))
        assert enc.ids(text) == enc.slow.encode(text, add_special_tokens=False).ids, text


def check_packing(found, rows, enc, capacity):
    want = Counter()
    for r in rows:
        ids = np.array([*enc.ids(r[1] or ""), 0], "<u4")
        at, k = 0, 0
        while at < len(ids):
            size = (len(ids) - at) % capacity or capacity
            want[r[0], k, at, size, zlib.crc32(ids[at : at + size].tobytes())] += 1
            at, k = at + size, k + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences: dict[int, list] = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_packing(documents, rows):
    enc = tokens.encoder(tokens.default_path())
    sequences = check_packing(packing.pack(documents, capacity=256, with_ids=True).collect(), rows, enc, 256)
    total = sum(n for parts in sequences.values() for _, n in parts)
    assert len(sequences) <= 1.05 * plain.least_sequences([total], 256) + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_under_all_capacities(rule):
    lengths = np.array([random.Random(i).randint(1, 100) for i in range(500)])
    bins, offsets = packing.best_fit(lengths, 100, 3, 5000 + 100 * 100 // 2, (1, 0.5, 0.5), rule)
    for b in set(bins.tolist()):
        mine = lengths[bins == b]
        assert mine.sum() <= 100 and len(mine) <= 3 and (mine**2).sum() <= 10000
        assert sorted(offsets[bins == b].tolist())[0] == 0


def test_packing_rounds(spark):
    """Many equal rows share a block; it is packed in several rounds."""
    docs = spark.createDataFrame([(1, "a b c")] * 100 + [(None, None)] * 3, "doc_id long, text string")
    found = packing.pack(docs, capacity=64, block_pieces=16).collect()
    enc = tokens.encoder(tokens.default_path())
    check_packing(found, [(1, "a b c")] * 100 + [(None, None)] * 3, enc, 64)


# --- SQL


@pytest.mark.parametrize("name", list(oracle.registered()))
def test_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "labels"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = connection.sql(oracle.registered()[name])
    got = queries.registered()[name](spark, sf_dir)
    assert Counter(want.fetchall()) == result(got, *want.columns)


def test_quality_cases(spark, documents, rows, nothing):
    got = quality.quality(documents)
    assert got.count() == len(rows)
    by_id = {r.doc_id: r for r in got.collect()}
    empty = by_id[120]
    assert (empty.n_words, empty.n_repeat_words, empty.base_failed, empty.kept, empty.kept_text) == (0, 0, True, False, "")
    assert by_id[5].n_repeat_words == by_id[5].n_words == 84
    text = "\n".join(["A good long line of words that says something at last."] * 1 + ["Home | About | Contact", "All rights reserved by them.", "no mark in this long line here"])
    one = quality.quality(spark.createDataFrame([(1, text + "\n" + " ".join(["word"] * 3) + " end.")], "doc_id long, text string"), min_words=5).first()
    assert one.kept_text == "A good long line of words that says something at last.\nword word word end."
    assert quality.quality(nothing).count() == 0


# --- kernels


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(" \n\tabé", max_size=12), max_size=6))
def test_words(texts):
    import pyarrow as pa

    data, offsets = kernels.buffer(pa.array(texts, pa.string()))
    found = kernels.Words(data, offsets, kernels.GRAPHIC)
    raw = data.tobytes()
    got = [(int(d), raw[a:b].decode()) for d, a, b in zip(found.doc, found.starts, found.ends)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in plain.words(t)]
    h = found.hashes()
    assert len({(x, int(y)) for (_, x), y in zip(got, h)}) == len({x for _, x in got})
    tidy, starts, ends = found.tidy()
    assert [tidy.tobytes()[a:b].decode() for a, b in zip(starts, ends)] == [w for _, w in got]
    for k in (1, 2, 3, 5):
        runs = kernels.runs_hash(h, k)
        assert len(runs) == max(0, len(h) - k + 1)
        by = {}
        for i, x in enumerate(runs.tolist()):
            assert by.setdefault(x, tuple(h[i : i + k].tolist())) == tuple(h[i : i + k].tolist())
        assert kernels.runs_min(h, k).tolist() == [int(h[i : i + k].min()) for i in range(max(0, len(h) - k + 1))]
