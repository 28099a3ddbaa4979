"""Plain versions of the operators, one text or pair at a time, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter


def words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def bench_words(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def bench(texts: list[str | None], items: list[tuple], window: int) -> list[tuple]:
    found = []
    for item, text in items:
        w = bench_words(text)
        if w:
            n = min(window, len(w))
            found.append(("" if item is None else str(item), {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}, n))
    out = []
    for text in texts:
        w = bench_words(text)
        hit, names = set(), set()
        for item, runs, n in found:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in runs:
                    hit |= set(range(i, i + n))
                    names.add(item)
        out.append((len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def line_order(rows: list[tuple]) -> list[int]:
    """Rows by id, those without one last."""
    return sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))


def dedup_lines(rows: list[tuple], threshold: float, min_words: int) -> dict[tuple, str]:
    """Kept text by (id, text); rows equal in both are one."""
    before: list[set[str]] = []
    out: dict[tuple, str] = {}
    for i in line_order(rows):
        key = (rows[i][0], rows[i][1])
        if key in out:
            continue
        kept = []
        for line in (rows[i][1] or "").split("\n"):
            tokens = words(line)
            if len(tokens) < min_words:
                kept.append(line)
                continue
            s = set(tokens)
            if not any(len(s & t) >= threshold * len(s | t) - 1e-9 for t in before):
                kept.append(line)
            before.append(s)
        out[key] = "\n".join(kept)
    return out


def edit_similarity(a: list, b: list) -> float:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return 1 - row[-1] / max(len(a), len(b), 1)


def alike(a: list, b: list, threshold: float) -> bool:
    shared = sum((Counter(a) & Counter(b)).values())  # at most so many words stay in place
    return shared >= threshold * max(len(a), len(b)) - 1e-9 and edit_similarity(a, b) >= threshold - 1e-9


def near_classes(rows: list[tuple], threshold: float) -> dict[tuple, tuple]:
    """(id, text) to the first (id, text) of its class, by comparing all pairs."""
    keys = sorted({(r[0], r[1] or "") for r in rows}, key=lambda k: (k[0] is None, k[0] or 0))
    split = {k: words(k[1]) for k in keys}
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = split[a], split[b]
            if x and y and min(len(x), len(y)) >= threshold * max(len(x), len(y)) - 1e-9 and (x == y or alike(x, y, threshold)):
                p, q = find(a), find(b)
                if p != q:
                    first, second = sorted((p, q), key=keys.index)
                    root[second] = first
    return {k: find(k) for k in keys}


def least_sequences(lengths: list[int], capacity: int) -> int:
    return math.ceil(sum(lengths) / capacity)
