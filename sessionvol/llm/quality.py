"""Line-first quality rules, as DataFrame functions only (operator 3).

Every line with a word is judged alone:

* punctuation: a line of MIN_SENTENCE_WORDS words or more without any sentence mark fails, and so does a line with
  more than one mark ``!`` or ``?`` for every three words, or with more symbols ``#*$%&<>`` than one for every four words;
* navigation: a line with a bar ``|`` for every three words or more fails;
* boilerplate: a line with one of BOILERPLATE fails.

Failed lines are removed. A document is kept if the lines left have at least ``min_left`` of its characters (those in
words), and it doesn't fail the base rules: fewer than ``min_words`` words, or over ``max_repeat`` percent of words in repeated windows.

Everything is computed row by row, so nothing is shuffled. Windows of words are compared by a 64-bit hash within a text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^ \t-\r]+"
SPACE = r"[ \t-\r]"
SYMBOLS = "[#*$%&|<>]"
MIN_SENTENCE_WORDS = 5
#: Phrases of lines that repeat over a site rather than say something.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "lorem ipsum", "licensed under", "skip to content", "subscribe to our newsletter", "click here", "sign up",
    "log in", "read more", "share this", "copyright (c)", "copyright ©",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, whatever the optimiser merges."""
    return F.element_at(F.transform(F.array(value), body), 1)


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def repeated_words(words: Column, window: int = 8) -> Column:
    """Number of words in windows that occur twice or more in the array; each word counts once."""

    def spread(starts: Column) -> Column:
        reach = F.transform(starts, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - x, F.lit(window))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def positions(s: Column) -> Column:
        twin = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda j: F.coalesce(F.get(s, j)["h"] == F.get(s, j - 1)["h"], F.lit(False))
            | F.coalesce(F.get(s, j)["h"] == F.get(s, j + 1)["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twin, lambda j: F.get(s, j)["i"]))

    def of_hashes(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        long_way = let(ordered, lambda s: let(positions(s), spread))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(long_way)

    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - window + 1), lambda i: F.xxhash64(F.slice(words, i, window))
    )
    return F.when(F.size(words) < window, F.lit(0).cast("long")).otherwise(let(hashes, of_hashes))


def line_fails(line: Column) -> Column:
    """Does a line with a word fail one of the rules?"""
    phrases = "|".join(x.replace("(", r"\(").replace(")", r"\)") for x in BOILERPLATE)
    return let(
        count_of(line, WORD),
        lambda n: (F.lit(4) * count_of(line, "[#*$%&<>]") > n)
        | (F.lit(3) * count_of(line, "[!?]") > n)
        | (F.lit(3) * count_of(line, "[|]") >= n)
        | ((n >= MIN_SENTENCE_WORDS) & ~line.rlike("[.!?…:;。！？]"))
        | F.lower(line).rlike(phrases),
    )


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, max_repeat: int = 30,
    min_left: float = 0.5, keep_text: bool = True,
) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    left_chars (characters in words of the lines left), kept, and with ``keep_text`` the lines left as kept_text.

    A NULL or empty text has no words and fails the base rules. Equal lines with a word count from the second on.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def line_stats(lines: Column) -> Column:
        left = F.filter(lines, lambda x: ~line_fails(x))
        return let(
            left,
            lambda x: F.struct(
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"),
                F.when(F.size(x) < F.size(lines), F.length(F.regexp_replace(F.array_join(x, ""), SPACE, "")).cast("long")).alias("chars"),
                (F.array_join(x, "\n") if keep_text else F.lit(None).cast("string")).alias("text"),
            ),
        )

    def word_stats(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), repeated_words(w).alias("again")
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    counted = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        let(words, word_stats).alias("w"),
        count_of(text, SYMBOLS).cast("long").alias("symbols"),
        let(lines, line_stats).alias("l"),
    )
    n, again = F.col("w.n"), F.col("w.again")
    left_chars = F.coalesce("l.chars", "w.chars")
    failed = (n < min_words) | (100 * again > max_repeat * n)
    out = counted.select(
        "doc_id", n.alias("n_words"), F.col("w.chars").alias("word_chars"), F.col("symbols").alias("n_symbols"),
        F.col("l.dup").alias("n_dup_lines"), again.alias("n_repeat_words"), failed.alias("base_failed"),
        left_chars.alias("left_chars"),
        (~failed & (left_chars >= min_left * F.col("w.chars"))).alias("kept"),
        F.col("l.text").alias("kept_text"),
    )
    return out if keep_text else out.drop("kept_text")
