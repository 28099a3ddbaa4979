"""Rare classes and rows that are equal."""

from __future__ import annotations

import random

import pyarrow as pa

from sessionvol.llm import repeats, toxicity


def test_rare_toxic_rows_are_fitted(spark):
    draw = random.Random(9)
    names = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(40)]
    texts = [(i, " ".join(draw.choices(names, k=12)) + (" zzyxqw vvkjqx" if i % 300 == 11 else "")) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 300 == 11)) for i in range(3000)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, fit_rows=100)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    toxic = [s for i, s in found.items() if i % 300 == 11]
    rest = sorted(s for i, s in found.items() if i % 300 != 11)
    assert min(toxic) > rest[int(0.99 * len(rest))], (sorted(toxic), rest[0], rest[1500], rest[-40:])


def test_equal_rows_share_their_spans(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text)] * 20 + [(None, text)] * 5, "doc_id long, text string")
    assert {r["n_removed"] for r in repeats.remove_repeats(docs).collect()} == {60}

    def sizes(keep_text):
        def run(batches):
            for batch in batches:
                lists = batch.column("spans").to_pylist()
                n, distinct = ([len(f([tuple(s.items()) for s in x])) for x in lists] for f in (list, set))
                hashes = pa.array([""] * len(n), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(distinct, pa.int64()), hashes],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

        return run

    monkeypatch.setattr(repeats, "_remove", sizes)
    assert all(r["n_words"] == r["n_removed"] for r in repeats.remove_repeats(docs, keep_text=False).collect())
