"""The whole join of lines: every link between different lines is made and counted."""

from __future__ import annotations

import random

import plain
import pytest

from sessionvol.llm import lines


def linked(texts: list[str]) -> list[int]:
    """Links of each text's lines by comparing all pairs of different lines."""
    sets = [[frozenset(plain.words(x)) for x in t.split("\n") if len(plain.words(x)) >= 5] for t in texts]
    every = {s for t in sets for s in t}
    count = {s: sum(s != o and len(s & o) >= 0.8 * len(s | o) - 1e-9 for o in every) for s in every}
    return [sum(count[s] for s in t) for t in sets]


@pytest.mark.parametrize("often, pairs", [(1024, 1 << 20), (4, 5)])
def test_all_links_of_a_family(spark, monkeypatch, often, pairs):
    monkeypatch.setattr(lines, "OFTEN", often)
    monkeypatch.setattr(lines, "PAIRS", pairs)
    draw = random.Random(2)
    names = [f"t{i}" for i in range(40)]
    family = draw.sample(names, 20)
    texts = []
    for _ in range(40):
        near = list(family)
        near[draw.randrange(20)] = draw.choice(names)
        texts.append("\n".join([" ".join(near), " ".join(draw.sample(names, 9)), "too short"]))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([*rows, rows[3], (90, None), (91, "")], "doc_id long, text string")
    got = lines.linked_lines(docs).collect()
    assert len(got) == 43
    assert {(r["doc_id"], r["n_links"]) for r in got} == {*enumerate(linked(texts)), (90, 0), (91, 0)}
    want = plain.dedup_lines(rows, 0.8, 5)
    assert {(r["doc_id"], r["kept_sha256"]) for r in got if r["doc_id"] < 90} == {(k[0], plain.sha(v)) for k, v in want.items()}
