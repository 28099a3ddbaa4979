"""Near pairs that must be found whatever else the corpus holds."""

from __future__ import annotations

import random
import uuid

import numpy as np
import pyarrow as pa
import pytest

from sessionvol.llm import nearcopies


def made_words(draw: random.Random, n: int) -> list[str]:
    return ["".join(draw.choices("abcdefghij", k=6)) for _ in range(n)]


def near_of(draw: random.Random, words: list[str], share: float) -> list[str]:
    out = list(words)
    for at in draw.sample(range(len(out)), int(len(out) * share)):
        out[at] = "".join(draw.choices("klmnopqrst", k=6))
    return out


def test_keys_do_not_depend_on_other_texts():
    draw = np.random.default_rng(3)
    text, other = draw.integers(1, 1 << 62, 80, dtype=np.uint64), draw.integers(1, 1 << 62, 9, dtype=np.uint64)
    repeating = np.concatenate([other, other, other])
    alone = nearcopies.sketch(text, np.zeros(80, np.int64), np.array([0, 80]), 5, 20, 2)
    doc = np.repeat([0, 1], [80, len(repeating)])
    beside = nearcopies.sketch(np.concatenate([text, repeating]), doc, np.array([0, 80, 80 + len(repeating)]), 5, 20, 2)
    assert (alone[0] == beside[0]).all()


def test_near_pair_in_unlike_partitions(spark):
    draw = random.Random(8)
    text = made_words(draw, 200)
    phrase = made_words(draw, 7)
    rows = [(1, " ".join(text)), (2, " ".join(near_of(draw, text, 0.02))), (3, " ".join(phrase * 6))]
    parts = spark.createDataFrame(rows[:1], "doc_id long, text string").coalesce(1)
    docs = parts.union(spark.createDataFrame(rows[1:], parts.schema).coalesce(1))
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in nearcopies.near_copies(docs).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (3, 0)}


def counted(docs: list[list[str]], threshold: float) -> list[int]:
    """Links of each text by comparing all pairs."""
    found = [0] * len(docs)
    ids = {w: i for i, w in enumerate(sorted({w for d in docs for w in d}))}
    coded = [np.array([ids[w] for w in d], np.uint64) for d in docs]
    for i in range(len(docs)):
        for j in range(i):
            if nearcopies.similar(coded[i], coded[j], threshold):
                found[i] += 1
                found[j] += 1
    return found


@pytest.mark.parametrize("light, block", [(16, 512), (3, 7)])
def test_all_links_under_crowded_keys(spark, monkeypatch, light, block):
    monkeypatch.setattr(nearcopies, "LIGHT", light)
    monkeypatch.setattr(nearcopies, "BLOCK_CLASSES", block)
    draw = random.Random(4)
    passage = made_words(draw, 150)
    # One passage in unlike texts of like lengths, with near copies of some of them, and one family of near copies.
    texts = [passage + made_words(draw, 100 + i % 5) for i in range(40)]
    texts += [near_of(draw, t, 0.01) for t in texts[10:30]]
    family = made_words(draw, 120)
    texts += [near_of(draw, family, 0.02) for _ in range(30)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in nearcopies.near_copies(docs).collect()}
    assert [found[i]["n_links"] for i in range(len(texts))] == counted(texts, 0.8)
    assert [found[40 + i]["class_id"] for i in range(20)] == list(range(10, 30))
    assert {found[i]["class_id"] for i in range(60, 90)} == {60}


def test_recall_at_the_threshold(spark):
    draw = random.Random(6)
    texts = [made_words(draw, 60) for _ in range(80)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(100 + i, " ".join(near_of(draw, t, 0.2))) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r for r in nearcopies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[100 + i]["class_id"] == i for i in range(80)) >= 79


def distance(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edits_in_a_band():
    draw = random.Random(1)
    for _ in range(4000):
        a = [draw.randrange(draw.choice((2, 4, 30))) for _ in range(draw.randint(0, 14))]
        b = list(a)
        for _ in range(draw.randint(0, 6)):
            at = draw.randint(0, len(b))
            b[at : at + draw.randint(0, 2)] = [draw.randrange(4)] * draw.randint(0, 2)
        most, want = draw.randint(0, 12), distance(a, b)
        got = nearcopies.Pattern(np.array(a, np.uint64)).edits(np.array(b, np.uint64), most)
        assert got == want if want <= most else got > most


@pytest.mark.parametrize("pairs, short", [(1 << 21, 8192), (300, 8192), (1 << 21, 30)])
def test_pivots_decide_as_alignments_do(monkeypatch, pairs, short):
    """Families with near and far members, some of which met under earlier keys; long texts have no pivots."""
    monkeypatch.setattr(nearcopies, "PAIRS", pairs)
    monkeypatch.setattr(nearcopies, "SHORT", short)
    draw = random.Random(2)
    texts = []
    for size in (40, 41, 120):
        base = [draw.randrange(10**6) for _ in range(size)]
        for _ in range(35):
            near = list(base)
            for _ in range(draw.choice((0, 1, 3, size // 10, size // 5, size // 4))):
                near[draw.randrange(len(near))] = draw.randrange(10**6)
            texts.append(np.array(near[: draw.randint(size - 4, size)], np.uint64))
    early = np.array([[draw.choice((0, 0, 0, 1000 + k)), draw.choice((0, 2000 + k))] for k in range(len(texts))], np.uint32)
    tile = nearcopies.Tile(texts, early, 0.8)
    tile.compare(np.arange(len(texts)), np.arange(len(texts)), True)
    want, part = [0] * len(texts), list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            most = int(0.2 * max(len(texts[i]), len(texts[j])) + 1e-9)
            if (early[i] != early[j]).all() and distance(texts[i].tolist(), texts[j].tolist()) <= most:
                want[i] += 1
                want[j] += 1
                part = [part[i] if p == part[j] else p for p in part]
    assert tile.links.tolist() == want
    assert all((tile.root(i) == tile.root(j)) == (part[i] == part[j]) for i in range(len(texts)) for j in range(i))


@pytest.mark.parametrize("kind", [np.uint16, np.uint32])
def test_edits_of_many_pairs(kind):
    """Edited copies and unrelated texts, in both orders, of lengths that differ."""
    draw = random.Random(7)
    for _ in range(40):
        base = [draw.randrange(draw.choice((3, 30))) for _ in range(draw.randint(1, 30))]
        texts = [[draw.randrange(5) for _ in range(draw.randint(1, 30))]]
        for _ in range(12):
            near = list(base)
            for _ in range(draw.randint(0, 8)):
                at = draw.randint(0, len(near))
                near[at : at + draw.randint(0, 2)] = [draw.randrange(30)] * draw.randint(0, 2)
            texts.append(near or [0])
        n = np.array([len(t) for t in texts])
        first, codes = np.cumsum(n) - n, np.concatenate(texts).astype(kind)
        x, y, most = (np.array([draw.randrange(k) for _ in range(60)]) for k in (len(texts), len(texts), 14))
        want = [min(distance(texts[a], texts[b]), m + 1) for a, b, m in zip(x, y, most)]
        assert nearcopies.edits_of_pairs(codes, first[x], n[x], first[y], n[y], most).tolist() == want


def test_pairs_of_a_crowded_key_are_not_aligned_one_by_one(monkeypatch):
    """Most of a family are near its first text, some as far as is allowed; the order in which they stand must not matter."""
    draw = random.Random(11)
    base = [draw.randrange(10**6) for _ in range(100)]
    texts = []
    for k in range(160):
        near = list(base)
        for _ in range(draw.choice((2, 3, 5)) if k % 4 else draw.randint(8, 20)):
            near[draw.randrange(len(near))] = draw.randrange(10**6)
        if k % 3 == 0:
            del near[draw.randrange(len(near))]
        texts.append(np.array(near, np.uint64))
    links = [0] * len(texts)
    for i, x in enumerate(texts):
        pattern = nearcopies.Pattern(x)
        for j in range(i):
            if pattern.edits(texts[j], 20) <= int(0.2 * max(len(x), len(texts[j])) + 1e-9):
                links[i] += 1
                links[j] += 1
    alone, similar, pattern = [], nearcopies.similar, nearcopies.Pattern
    monkeypatch.setattr(nearcopies, "similar", lambda *pair: alone.append(1) or similar(*pair))
    monkeypatch.setattr(nearcopies, "PAIRS", 2000)  # pairs of many parts, whose pivots are the same
    monkeypatch.setattr(nearcopies, "Pattern", lambda x: alone.append(1) or pattern(x))
    tile = nearcopies.Tile(texts, np.zeros((len(texts), 0), np.uint32), 0.8)
    rows = np.arange(len(texts))
    tile.compare(rows, rows, True)
    assert tile.links.tolist() == links
    assert len(alone) < 100  # of 12,720 pairs


def test_words_go_only_where_a_pair_meets_first(spark, monkeypatch, tmp_path):
    """A family shares most of its keys, but each of its pairs is verified under one of them."""
    draw, folder, tiles = random.Random(5), str(tmp_path), nearcopies._tiles

    def counting(threshold):
        run = tiles(threshold)

        def counted(batches):
            def seen():
                for batch in batches:
                    with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                        file.write(str(len(batch)))
                    yield batch

            yield from run(seen())

        return counted

    monkeypatch.setattr(nearcopies, "_tiles", counting)
    family = made_words(draw, 120)
    texts = [" ".join(near_of(draw, family, 0.02)) for _ in range(30)] + [" ".join(made_words(draw, 90)) for _ in range(10)]
    texts += [" ".join(family + made_words(draw, 150))]  # shares keys, but is too long
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3])], "doc_id long, text string")  # and one row comes twice
    found = {r["doc_id"]: r["n_links"] for r in nearcopies.near_copies(docs).collect()}
    assert [found[i] for i in range(len(texts))] == counted([t.split() for t in texts], 0.8)

    (_, _, words, h), = nearcopies._word_groups(pa.array(texts))
    keys, n = nearcopies.sketch(h, words.doc, words.first, 2, 48, 3), np.diff(words.first)
    needed, shared = set(), set()
    for i in range(len(texts)):
        for j in range(i):
            both = np.flatnonzero(keys[i] == keys[j]).tolist()
            shared |= {(k, keys[i, k], r) for k in both for r in (i, j)}
            if both and abs(n[i] - n[j]) <= nearcopies.allowed(n[i], n[j], 0.8):
                needed |= {(both[0], keys[i, both[0]], r) for r in (i, j)}
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == len(needed) < len(shared) / 2


@pytest.mark.parametrize("pairs", [1 << 21, 300])
def test_rows_with_a_pair_to_be_verified(monkeypatch, pairs):
    monkeypatch.setattr(nearcopies, "PAIRS", pairs)
    draw = random.Random(9)
    for rows in (2, 9, 90, 200):
        n = np.array([draw.randint(1, 400) for _ in range(rows)])
        early = np.array([[draw.choice((0, 0, 0, 1000 + k)), draw.choice((0, 0, 0, 2000 + k))] for k in range(rows)], np.uint32)
        block = np.array([draw.randrange(2) for _ in range(rows)])
        for x, y in ((0, 0), (0, 1)):
            meeting = nearcopies.Meeting(n, early, 0.8)
            nearcopies._meet(meeting, np.zeros(rows, int) if x == y else block, x, y)
            met = [[i != j and (x == y or block[i] != block[j]) and (early[i] != early[j]).all() and abs(n[i] - n[j]) <= int(0.2 * max(n[i], n[j]) + 1e-9) for j in range(rows)] for i in range(rows)]
            assert meeting.paired.tolist() == [any(row) for row in met]
