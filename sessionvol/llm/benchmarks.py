"""Benchmark decontamination: a generalised suffix automaton of the test items (operator 9).

The words of all items, with a separator of its own after each, make one suffix automaton. The words of
a text stream through it; at each word the automaton knows the longest run that ends there and also lies in an item.
A run of ``window`` words or more is a hit of the item's windows, and every word of it counts as hit. An item of
fewer words is hit where it occurs whole.

Before the automaton, words that are in no item are found for a whole batch by their hashes; only
stretches of item words that are long enough for the shortest window are streamed.

At scale: texts are never shuffled. The items' automaton goes to all tasks, so items are taken in blocks of at
most ``block_bytes`` of text; each block is one pass over the texts, and with more than one block the spans of a text are merged by
its row key.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import kernels as K
from sessionvol.llm.rows import K1, K2, row_key, ship
from sessionvol.session import settle

#: Bytes of item texts whose automaton is sent to all tasks at once.
BLOCK_BYTES = 4 << 20


def item_words(text: str | None) -> list[bytes]:
    data, offsets = K.buffer(pa.array([text or ""]))
    data = K.LOWER[data]
    words = K.Words(data, offsets, K.ALNUM)
    flat = data.tobytes()
    return [flat[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]


class Automaton:
    """Suffix automaton over word numbers, with the items that own each window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        last, texts, separator = 0, [], -1
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number)) for w in item_words(text)]
            if ids:
                texts.append((item, ids))
                for x in ids:
                    last = self._add(last, x)
                last = self._add(last, separator)
                separator -= 1
        #: State of a window, or of a whole short item, to the items that have it.
        self.owners: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for item, ids in texts:
            state = length = 0
            for x in ids:
                state, length = self.step(state, length, x)
                if length >= window:
                    self.owners.setdefault(self.cut(state, window), set()).add(item)
            if len(ids) < window:
                self.short.setdefault(len(ids), {}).setdefault(self.cut(state, len(ids)), set()).add(item)
        self.least = min([window, *self.short]) if texts else 0
        words = sorted(self.number, key=lambda w: self.number[w])
        flat = pa.array(words, pa.binary())
        data, offsets = K.buffer(flat)
        every = K.Words(data, offsets, np.ones(256, bool))
        self.hashes = every.hashes()
        # Hashes by their top bits: a first look that needs no search.
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.hashes >> np.uint64(44)] = True
        self.hashes = np.sort(self.hashes)

    def _add(self, last: int, x: int) -> int:
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p != -1 and x not in self.next[p]:
            self.next[p][x] = new
            p = self.link[p]
        if p == -1:
            return new
        q = self.next[p][x]
        if self.length[p] + 1 == self.length[q]:
            self.link[new] = q
            return new
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        while p != -1 and self.next[p].get(x) == q:
            self.next[p][x] = copy
            p = self.link[p]
        self.link[q] = self.link[new] = copy
        return new

    def step(self, state: int, length: int, x: int) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        after = self.next[state].get(x)
        while after is None:
            state = self.link[state]
            if state < 0:
                return 0, 0
            length = self.length[state]
            after = self.next[state].get(x)
        return after, length + 1

    def cut(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], set[str]]:
        """Spans (from, to, longest match) of hit words, and the items hit."""
        spans: list[tuple[int, int, int]] = []
        items: set[str] = set()
        state = length = 0
        for i, w in enumerate(words):
            x = self.number.get(w)
            if x is None:
                state = length = 0
                continue
            state, length = self.step(state, length, x)
            reach = 0
            if length >= self.window:
                items |= self.owners[self.cut(state, self.window)]
                reach = length
            elif length < self.least:
                continue
            for n, ends in self.short.items():
                if n <= length and (got := ends.get(self.cut(state, n))):
                    items |= got
                    reach = max(reach, n)
            if reach:
                low = i + 1 - reach
                while spans and spans[-1][1] >= low:  # one span per run of hit words
                    a, _, longest = spans.pop()
                    low, reach = min(low, a), max(reach, longest)
                spans.append((low, i + 1, reach))
        return spans, items

    def candidates(self, words: K.Words) -> list[tuple[int, int, int]]:
        """Text and word range of each stretch of item words of the shortest window's length or more."""
        h = words.hashes()
        known = self.bits[h >> np.uint64(44)]
        i = np.flatnonzero(known)
        if len(i):
            at = np.minimum(np.searchsorted(self.hashes, h[i]), len(self.hashes) - 1)
            i = i[self.hashes[at] == h[i]]
        if not len(i):
            return []
        cut = np.ones(len(i), bool)
        cut[1:] = (i[1:] != i[:-1] + 1) | (words.doc[i[1:]] != words.doc[i[:-1]])
        a = np.flatnonzero(cut)
        size = np.diff(np.append(a, len(i)))
        a, size = i[a][size >= self.least], size[size >= self.least]
        return list(zip(words.doc[a].tolist(), a.tolist(), (a + size).tolist(), strict=True))


def find(auto: Automaton, column: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int, int]]], list[set[str]]]:
    """Number of words, spans of hit words and items of each text of a column."""
    data, offsets = K.buffer(column)
    n_words, spans, items = [np.zeros(0, np.int64)], [[] for _ in range(len(column))], [set() for _ in range(len(column))]
    for a, b in K.chunks(offsets):
        part = K.LOWER[data[offsets[a] : offsets[b]]]
        words = K.Words(part, offsets[a : b + 1] - offsets[a], K.ALNUM)
        n_words.append(np.diff(words.first))
        if not auto.least:
            continue
        flat = None
        for row, lo, hi in auto.candidates(words):
            flat = flat or part.tobytes()
            got, hit = auto.stream(
                [flat[p:q] for p, q in zip(words.starts[lo:hi].tolist(), words.ends[lo:hi].tolist(), strict=True)]
            )
            at = lo - int(words.first[row])
            spans[a + row] += [(p + at, q + at, n) for p, q, n in got]
            items[a + row] |= hit
    return np.concatenate(n_words), spans, items


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for lo, hi, longest in sorted(spans):
        if out and lo <= out[-1][1]:
            a, b, n = out.pop()
            lo, hi, longest = a, max(b, hi), max(n, longest)
        out.append((lo, hi, longest))
    return out


_SPANS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("longest", pa.int64())]))
_HITS = f"{K1} long, {K2} long, spans array<struct<lo:long,hi:long,longest:long>>, items array<string>"


def _owned(block, column):
    """``find``, with the ids of the items that have the texts found."""
    automaton, owners = block
    n_words, spans, texts = find(automaton, column)
    return n_words, spans, [{o for k in found for o in owners[int(k)]} for found in texts]


def _one_pass(automaton, text_col: str, apply):
    """All texts against the only block of items."""

    def run(batches):
        for batch in batches:
            yield apply(batch, *_owned(automaton.value, batch.column(batch.schema.get_field_index(text_col))))

    return K.lean(run)


def _hits(automaton):
    """Texts that a block of items hits."""

    def run(batches):
        for batch in batches:
            _, spans, items = _owned(automaton.value, batch.column("text"))
            i = [k for k, s in enumerate(spans) if s]
            lists = [[{"lo": p, "hi": q, "longest": n} for p, q, n in spans[k]] for k in i]
            keys = [batch.column(c).take(pa.array(i, pa.int64())) for c in (K1, K2)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(lists, _SPANS), pa.array([sorted(items[k]) for k in i], pa.list_(pa.string()))], names=[K1, K2, "spans", "items"]
            )

    return K.lean(run)


def _gathered(text_col: str, spans_col: str, items_col: str, apply):
    """Texts with the spans that all blocks found."""

    def run(batches):
        none = Automaton([], 1)
        for batch in batches:
            found = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (spans_col, items_col)]
            n_words, _, _ = find(none, batch.column(batch.schema.get_field_index(text_col)))
            spans = [[(s["lo"], s["hi"], s["longest"]) for x in lists or () for s in x] for lists in found[0]]
            items = [{i for x in lists or () for i in x} for lists in found[1]]
            yield apply(batch.drop_columns([spans_col, items_col]), n_words, spans, items)

    return K.lean(run)


def _digest(batch, n_words, spans, items):
    merged = [_merged(s) for s in spans]
    n_hit = [sum(b - a for a, b, _ in s) for s in merged]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_()),
        ],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    )


def _clean(text_col: str, min_words: int, max_coverage: float):
    def apply(batch, n_words, spans, items):
        at = batch.schema.get_field_index(text_col)
        texts = None
        for i, found in enumerate(spans):
            if found:
                texts = texts or batch.column(at).to_pylist()
                merged = _merged(found)
                over = sum(b - a for a, b, _ in merged) > max_coverage * n_words[i]
                gone = [(a, b) for a, b, longest in merged if over or longest >= min_words]
                texts[i] = _without(texts[i], gone)
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)) if texts else batch

    return apply


def _without(text: str, gone: list[tuple[int, int]]) -> str:
    """The text without the bytes from the first to the last word of each span; the rest as it is."""
    raw = text.encode()
    data, offsets = K.buffer(pa.array([text]))
    words = K.Words(K.LOWER[data], offsets, K.ALNUM)
    out, at = [], 0
    for a, b in gone:
        out.append(raw[at : words.starts[a]])
        at = int(words.ends[b - 1])
    return b"".join([*out, raw[at:]]).decode()


def match(
    docs: DataFrame, items: DataFrame, apply, schema, text_col: str, key: list, item_id_col: str, item_text_col: str, window: int, block_bytes: int
) -> DataFrame:
    """``apply`` of every batch of ``docs`` and what its texts have of the items.

    Rows of items that share an id are one item with several texts; an item without an id counts as the
    item ''. Items of equal text share one text, which is sent once. Runs jobs over the items when called.
    """
    spark = docs.sparkSession
    ship(spark)
    known = items.select(
        F.coalesce(F.col(f"`{item_id_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{item_text_col}`").alias("text")
    ).filter(F.octet_length("text") > 0)
    # Equal texts are one, with the ids of all items that have it.
    texts = settle(known.groupBy("text").agg(F.sort_array(F.collect_set("item")).alias("owners")))
    owners = F.aggregate("owners", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x) + 1)
    size = texts.agg(F.sum(F.octet_length("text") + owners)).first()[0] or 0
    n_blocks = size // block_bytes + 1
    block = F.pmod(F.xxhash64("text"), F.lit(n_blocks))
    found = []
    for k in range(n_blocks):
        rows = sorted(texts.filter(block == k).collect())  # about block_bytes
        automaton = Automaton([(str(i), r[0]) for i, r in enumerate(rows)], window)
        automaton = spark.sparkContext.broadcast((automaton, [r[1] for r in rows]))
        if n_blocks == 1:
            return docs.mapInArrow(_one_pass(automaton, text_col, apply), schema)
        read = docs.select(*key, F.col(f"`{text_col}`").alias("text"))
        found.append(read.mapInArrow(_hits(automaton), _HITS))
    hits = reduce(DataFrame.union, found).distinct().groupBy(K1, K2).agg(
        F.collect_list("spans").alias("__llm_spans"), F.collect_list("items").alias("__llm_items")
    )
    joined = docs.select("*", *(c.alias(f"{n}x") for c, n in zip(key, (K1, K2)))).join(
        hits, (F.col(f"{K1}x") == F.col(K1)) & (F.col(f"{K2}x") == F.col(K2)), "left"
    ).drop(K1, K2, f"{K1}x", f"{K2}x")
    return joined.mapInArrow(_gathered(text_col, "__llm_spans", "__llm_items", apply), schema)


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted ids, comma-joined), contaminated.

    Words are [0-9a-z] and everything beyond ASCII, A-Z lower-cased. NULL and empty texts have no words and are never hit; items without words are
    in no result; without items nothing is hit. Equal rows have equal results.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return match(rows, items, _digest, schema, "text", row_key("doc_id", "text"), item_id_col, item_text_col, window, block_bytes)


def remove_passages(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = 10, min_words: int = 1, max_coverage: float = 1.0, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` with all their columns, the text without hit spans whose longest match has ``min_words`` words or more, and
    without all hit spans once they cover more than ``max_coverage`` of its words. NULL stays NULL."""
    apply = _clean(text_col, min_words, max_coverage)
    return match(docs, items, apply, docs.schema, text_col, row_key(id_col, text_col), item_id_col, item_text_col, window, block_bytes)
