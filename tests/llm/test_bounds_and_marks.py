"""Bounds on what reaches the driver, texts over one chunk, and pages whose marks mislead."""

from __future__ import annotations

import random

import plain
import pytest
from pyspark.sql import functions as F

from sessionvol.llm import benchmarks, chat, kernels, languages, lines, nearcopies, pages, quality, repeats, toxicity

BODY = "The body of the page says a good deal about its subject, in whole sentences. " * 3


def test_equal_items_are_sent_once(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(12))
    items = spark.range(20_000).select(F.col("id").alias("item_id"), F.when(F.col("id") < 19_990, text).otherwise(F.concat(F.lit("other "), F.col("id"), F.lit(text))).alias("text"))
    docs = spark.createDataFrame([(1, f"see {text} here"), (2, "nothing"), (3, None)], "doc_id long, text string")
    built = []
    make = benchmarks.Automaton.__init__
    monkeypatch.setattr(benchmarks.Automaton, "__init__", lambda self, found, window: (built.append(len(found)), make(self, found, window))[1])
    got = {r["doc_id"]: r for r in benchmarks.decontaminate(docs, items).collect()}
    assert built == [11]
    want = plain.sha(",".join(sorted(map(str, range(20_000)))))
    assert (got[1]["n_items"], got[1]["n_hit"], got[1]["items_sha256"]) == (20_000, 12, want)
    assert got[2]["n_items"] == got[3]["n_items"] == 0
    both = benchmarks.decontaminate(docs, items, block_bytes=70_000)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, got.values()))


def test_few_bytes_for_the_fit(spark):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(("vile", "nasty") if i % 2 else ("kind", "calm"), k=30)), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxicity.train(docs, labels, fit_bytes=20_000)).collect()}
    assert sum(got[r[0]] == r[2] for r in rows) > 390


@pytest.mark.parametrize("html, want", [
    (f"<article class='teaser'><p>Short teaser text.</p></article><div><p>{BODY}</p><p>{BODY}</p></div>", [BODY, BODY]),
    (f"<article><h1>Title</h1><div class='side-by-side'><p>{BODY}</p></div><div id='related-work'><p>Earlier work is older.</p></div>"
     f"<div class='related'><p>Read this too</p></div><div class='side'><p>Beside</p></div></article>", ["Title", BODY, "Earlier work is older."]),
    (f"<nav>Home</nav><main><article><p>{BODY}</p></article><article><p>Second of them.</p></article></main><footer>End</footer>", [BODY, "Second of them."]),
    (f"<div id='menu'>Home | News</div><p>{BODY}</p><div class='comments'><p>First!</p></div>", [BODY]),
    ("", []), (None, []), ("<p></p>", []), ("no markup at all", []),
])
def test_pages_with_and_without_marks(html, want):
    got = pages.main_text(html or "")
    text = " ".join(got.split())
    for part in want:
        assert " ".join(part.split()) in text
    for aside in ("Read this too", "Beside", "Home", "End", "First!"):
        assert aside not in text
    if not want:
        assert got == "" or html == "no markup at all"


def test_pages_of_nothing_and_clashing_columns(spark, clashing):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.extract(none).count() == 0
    odd = clashing.withColumnsRenamed({"doc_id": "page_id", "text": "html", "n": "url", "line": "n_chars", "a": "article"})
    got = pages.extract(odd.union(odd))
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 4
    assert {r["text"] for r in got.filter("page_id IS NULL").collect()} == {""}


def test_texts_of_over_one_chunk(spark):
    """Each operator on texts of 2 MB: whole, and as its rules say."""
    draw = random.Random(7)
    words = [f"w{draw.randrange(10**6)}" for _ in range(260_000)]
    text = "\n".join(" ".join(words[i : i + 40]) + "." for i in range(0, len(words), 40))
    assert len(text) > 1.5 * kernels.CHUNK
    near = text.replace(words[100], "changed").replace(words[200_000], "altered")
    rows = [(1, text, "xx"), (2, near, "xx"), (3, "a short one, of seven words here.", "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    last = " ".join(words[-12:])
    items = spark.createDataFrame([(5, last)], "item_id long, text string")
    assert {r["doc_id"]: r["n_hit"] for r in benchmarks.decontaminate(docs, items).collect()} == {1: 12, 2: 12, 3: 0}
    assert {r["doc_id"]: r["class_id"] for r in nearcopies.near_copies(docs).collect()} == {1: 1, 2: 1, 3: 3}
    gone = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in lines.dedup_lines(docs).collect()}
    assert gone[1] == (6500, 0) and gone[2][0] == 6500 and gone[2][1] >= 6498 and gone[3] == (1, 0)
    counts = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in repeats.remove_repeats(docs, keep_text=False).collect()}
    want = plain.repeats([r[1] for r in rows], 35)
    assert [counts[i] for i in (1, 2, 3)] == [w[:2] for w in want]
    assert {r["doc_id"]: r["n_words"] for r in quality.quality(docs, keep_text=False).collect()} == {1: 260_000, 2: 260_000, 3: 7}
    named = languages.predict(docs, languages.learn(docs))
    assert {r["doc_id"]: r["lang_pred"] for r in named.collect()} == {1: "xx", 2: "xx", 3: "yy"}
    turns = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", near)], "conv_id long, turn long, role string, text string")
    told = chat.digests(chat.format_windows(turns)).first()
    assert told.turns_sha256 == plain.sha(f"user\n{text}\nassistant\n{near}\n") and told.loss_chars == len(near)
    page = spark.createDataFrame([(1, "u", f"<article><p>{text}</p></article>")], "page_id long, url string, html string")
    assert pages.extract(page).first().text == " ".join(text.split())
