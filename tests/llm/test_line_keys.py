"""The join of lines, key by key: frequent tokens, long lines, crowded keys and tiles of blocks give every link once."""

from __future__ import annotations

import random

import numpy as np
import plain
import pyarrow as pa
import pytest

from sessionvol.llm import kernels as K
from sessionvol.llm import lines


class Ranked(lines.Order):
    """An order of tokens by number; those over ``often`` are frequent."""

    def __init__(self, often: int):
        self.often = often

    def code(self, token: int) -> int:
        return token << 40 | int(K.mix(np.array([token], np.uint64))[0] & lines._HASH)


def links_by_key(sets, order, threshold, crowd):
    codes = [np.array(sorted(order.code(t) for t in s), np.uint64) for s in sets]
    n = np.array([len(c) for c in codes])
    begin = np.cumsum(n) - n
    line, key, at, step = lines._entries(np.concatenate(codes), begin, n, threshold, order)
    m = K.mix(np.concatenate(codes))
    flip, second = np.uint64(1) << (m >> np.uint64(58)), (((m >> np.uint64(57)) & np.uint64(1)) > 0) & np.repeat(n >= lines.LONG, n)
    bits, more = (np.bitwise_xor.reduceat(np.where(second == k, flip, np.uint64(0)), begin) for k in (False, True))
    numbers = {k: i for i, k in enumerate(sorted(set(key.tolist())))}
    entry = {
        "code": np.array([numbers[k] for k in key.tolist()], np.uint32), "s1": line.astype(np.int64), "bits": bits[line], "bits2": more[line],
        "n": n[line].astype(np.uint32), "at": at.astype(np.uint32), "step": step.astype(np.int32),
    }
    blob = b"".join(lines._planes(entry[f].astype(k)) for f, k in lines._ENTRY.items())
    found = lines._live([(len(line), pa.Codec("zstd", 1).compress(blob, asbytes=True))], threshold)
    links, later = np.zeros(len(sets), np.int64), np.zeros(len(sets), bool)
    if found is None:
        return links, later
    code, s1, at, step, many, print1, print2, place, lead = found
    firsts = {}
    for r in np.flatnonzero(lead).tolist():
        group = (many[r], print1[r], print2[r])
        firsts[group] = min(firsts.get(group, (1 << 62, 0)), (place[r], code[r]))
    for k in sorted(k for _, k in firsts.values()):
        rows = np.flatnonzero(code == k)
        assert (many[rows] == len(rows)).all()
        own = s1[rows]
        tile = lines.Tile([codes[i] for i in own.tolist()], at[rows], step[rows], own, threshold)
        token = codes[own[0]][at[rows][0]]
        frequent = not order.is_rare(np.array([token]))[0]
        half = np.arange(len(rows)) % crowd
        for x in range(crowd):
            for y in range(x, crowd):
                a, b = np.flatnonzero(half == x), np.flatnonzero(half == y)
                if len(a) and len(b):
                    tile.compare(a, b, x == y, frequent)
        np.add.at(links, own, tile.links)
        later[own] |= tile.later
    return links, later


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("often, long, hot, pairs", [(1 << 20, 64, 4096, 1 << 20), (0, 64, 4096, 1 << 20), (12, 8, 4096, 16), (6, 10, 2, 1 << 20), (0, 7, 1, 4)])
def test_every_link_once(monkeypatch, seed, often, long, hot, pairs):
    for name, value in (("LONG", long), ("HOT", hot), ("PAIRS", pairs)):
        monkeypatch.setattr(lines, name, value)
    draw = random.Random(seed)
    threshold = draw.choice((0.5, 0.6, 0.8, 0.9))
    sets = set()
    for _ in range(12):
        base = draw.sample(range(1, 30), draw.randint(1, 18))
        for _ in range(draw.randint(1, 14)):
            s = set(base)
            for _ in range(draw.randint(0, 3)):
                s ^= {draw.randrange(1, 30)}
            if s:
                sets.add(frozenset(s))
    sets = sorted(sets, key=sorted)
    links, later = links_by_key(sets, Ranked(often), threshold, 1 + seed % 3)
    alike = lambda s, o: len(s & o) >= threshold * len(s | o) - 1e-9
    assert links.tolist() == [sum(s != o and alike(s, o) for o in sets) for s in sets]
    assert later.tolist() == [any(alike(s, o) for o in sets[:i]) for i, s in enumerate(sets)]


def test_length_classes():
    n = np.arange(1, 3000)
    for t in (0.5, 0.8, 0.95):
        c = lines._length_class(n, t)
        least = np.ceil(t * n - 1e-9).astype(int)
        assert (c - c[least - 1] <= 1).all()


def test_long_lines_and_frequent_words(spark, monkeypatch):
    """A line of 60,000 words, near copies of lines of 50 to 300 words, and tokens that are all frequent."""
    monkeypatch.setattr(lines, "OFTEN", 6)
    monkeypatch.setattr(lines, "BLOCK", 5)
    draw = random.Random(8)
    names = [f"w{i}" for i in range(400)]
    texts = []
    for size in (50, 60, 63, 64, 70, 79, 80, 120, 300):
        base = draw.sample(names, size)
        for _ in range(7):
            near = list(base)
            for _ in range(size // 12):
                near[draw.randrange(size)] = draw.choice(names)
            texts.append(" ".join(near[: draw.randint(int(size * 0.9), size)]))
    huge = [f"h{i}" for i in range(60_000)]
    texts += [" ".join(huge), " ".join(huge[5_000:]), " ".join(huge[25_000:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_links"], r["n_removed"]) for r in lines.linked_lines(docs).collect()}
    sets = [frozenset(plain.words(t)) for t in texts]
    every = set(sets)
    alike = lambda s, o: len(s & o) >= 0.8 * len(s | o) - 1e-9
    for i, s in enumerate(sets):
        assert got[i] == (sum(s != o and alike(s, o) for o in every), int(any(alike(s, o) for o in sets[:i]))), i


def test_frequent_tokens_are_counted_exactly(spark):
    draw = random.Random(9)
    words = ["often"] * 3000 + ["also"] * 1024 + ["nearly"] * 1023 + [f"r{i}" for i in range(5000)] * 2
    draw.shuffle(words)
    docs = spark.createDataFrame([(i, " ".join(words[i::50])) for i in range(50)], "doc_id long, text string").repartition(3)
    order, size = lines._token_order(lines.keyed(docs, "doc_id", "text"))
    h = K.Words(np.frombuffer(b"often also nearly r1", np.uint8), np.array([0, 20]), K.GRAPHIC).hashes()
    codes = order.codes(h)
    assert order.is_rare(codes).tolist() == [False, False, True, True] and len(order.tokens) == 2
    assert codes[0] > codes[1] > codes[2] and size == sum(len(w) + 1 for w in words) - 50
