"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def make_documents(n: int = 120, seed: int = 5) -> list[tuple]:
    """Random prose with copies, near copies, shared passages, repeated lines, odd white space and empty texts."""
    draw = random.Random(seed)
    syllables = "an ber co de el fi ga ho is ja ké lo mu né or pa qu ri so tü".split()

    def word() -> str:
        return "".join(draw.choices(syllables, k=draw.choice((1, 1, 2, 2, 3, 4))))

    def line(k: int) -> str:
        return " ".join(word() for _ in range(k)).capitalize() + "."

    passage, common = line(60), line(9)
    texts: list[str] = []
    for i in range(n):
        kind = i % 12
        body = [line(draw.choice((3, 8, 15, 40))) for _ in range(draw.randint(1, 8))]
        text = "\n".join(body)
        if kind == 1:
            text = texts[-1]
        elif kind == 2:
            w = texts[draw.randrange(len(texts))].split(" ")
            for _ in range(1 + len(w) // 40):
                w[draw.randrange(len(w))] = word()
            text = " ".join(w)
        elif kind == 3:
            text = "\n".join([*body, passage, common, common])
        elif kind == 4:
            text = "\n".join([line(draw.randint(1, 40)) + " " + passage + " " + line(12), *body])
        elif kind == 5:
            text = " ".join([line(7)] * 12)
        elif kind == 6:
            text = "\t" + "  \n\n ".join(body) + "\x0b \r\n"
        elif kind == 7:
            w = common.split(" ")
            w[draw.randrange(len(w))] = word()
            text = "\n".join([" ".join(w), *body])
        texts.append(text)
    rows = [(i, t, "xx" if i % 3 else "yy", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    rows += [
        (n, None, None, None, None), (n + 1, "", "xx", "s", 0), (n + 2, " \n\t ", "xx", "s", 4), (n + 3, "one", "xx", "s", 3),
        (None, texts[0], "xx", None, 5), (7, texts[8], "xx", "s", 1), (7, texts[8], "xx", "s", 1), (9, "!!! ### 12 34", "xx", "s", 1),
        (n + 4, " ".join(word() for _ in range(3000)), "xx", "long", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_documents()


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(spark):
    """Columns named like those that operators add or use, and only NULL in one row."""
    names = [
        "doc_id", "text", "score", "n_words", "bucket", "spans", "line", "a", "n", "keys", "block", "lang_pred", "stay", "items", "first", "class",
        "kept_text", "toxic", "key", "sequence_id",
    ]
    schema = T.StructType([T.StructField(c, T.LongType() if c == "doc_id" else T.StringType()) for c in names])
    rows = [(1, "alpha beta gamma delta epsilon zeta.", *["x"] * (len(names) - 2)), (None,) * len(names)]
    return spark.createDataFrame(rows, schema)
