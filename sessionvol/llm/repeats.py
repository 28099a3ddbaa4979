"""Substring dedup: super-k-mer partitioning of word windows (operator 4).

A window is ``window`` consecutive words of one text. The minimiser of a window is the smallest hash
among its runs of ``minimiser`` words. Consecutive windows with the same minimiser form a super-k-mer:
their words travel once, as one packed string, to the bucket that the minimiser names. All windows with
the same words meet in one bucket, where they are sorted by a hash and counted; equal hashes are
compared byte by byte, so counts are exact.

At scale: the number of buckets follows the bytes of the table, so that a bucket holds about
BUCKET_BYTES of packed words. A minimiser with more super-k-mers than a quarter of a bucket's share (there are
at most four such per bucket, which bounds the broadcast list) is hot; its windows are dealt one by one by
their own hash instead. Equal strings are packed once per task, with the list of their places.

A window at very many places is heavy. Its words are known to every task, which compares them byte by byte and marks
the places itself: they are sent on as spans, from any partition to any other, and meet in no bucket. The heavy windows are at most HEAVY_MOST;
further ones are counted in their buckets like the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import kernels as K
from sessionvol.llm.rows import K1, K2, keyed, ship, shuffle_partitions, text_bytes
from sessionvol.session import settle

#: Bytes of packed strings that one bucket should hold.
BUCKET_BYTES = 16 << 20
#: A minimiser of fewer super-k-mers is never hot.
HOT_LEAST = 1000
#: A window at fewer places is never heavy.
HEAVY_LEAST = 1000
#: Heavy windows that the tasks know (some 300 bytes each).
HEAVY_MOST = 50_000
#: Bytes of words whose strings are packed together.
PACK_BYTES = 8 << 20
#: Packed strings have about this many bytes per byte of text: a super-k-mer of n windows repeats window - 1 words.
BLOW_UP = 3.3


def _super_kmers(
    words: K.Words, h: np.ndarray, window: int, minimiser: int, buckets: int, hot: np.ndarray, heavy: np.ndarray | None = None
):
    """First word, number of windows and bucket of each super-k-mer of a group of texts; windows in ``heavy`` are left out."""
    good = K.within(words.doc, window)
    if heavy is not None:
        good[heavy] = False
    if not len(good):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64)
    low = K.runs_min(K.runs_hash(h, minimiser), window - minimiser + 1)[: len(good)]
    bucket = (low % np.uint64(buckets)).astype(np.int64)
    cut = np.ones(len(good), bool)
    cut[1:] = (low[1:] != low[:-1]) | ~good[:-1] | (words.doc[1 : len(good)] != words.doc[: len(good) - 1])
    if heavy is not None:
        cut[heavy] = True
    if len(hot):
        found = np.minimum(np.searchsorted(hot, low), len(hot) - 1)
        single = hot[found] == low
        own = K.runs_hash(h, window)[: len(good)]
        bucket[single] = (own[single] % np.uint64(buckets)).astype(np.int64)
        cut |= single
        cut[1:] |= single[:-1]
    first = np.flatnonzero(cut)
    size = np.diff(np.append(first, len(good)))
    # Windows over the edge of a text are no windows; a piece is all good or all bad but for such tails.
    tail = np.add.reduceat(good.astype(np.int64), first) if len(first) else size
    use = tail > 0
    return first[use], tail[use], bucket[first][use], low[first][use]


def _groups(column: pa.Array) -> Iterator[tuple[int, K.Words]]:
    data, offsets = K.buffer(column)
    for a, b in K.chunks(offsets):
        yield a, K.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], K.GRAPHIC)


def _frequent(values: list[np.ndarray], buckets: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of all values, and those over a share of them with their counts: sums over groups miss at most that share."""
    found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *values]), return_counts=True)
    use = n >= max(2, n.sum() / (16 * buckets))
    return int(n.sum()), found[use].view(np.int64), n[use]


def _count_minimisers(window: int, minimiser: int, buckets: int):
    """Counts of minimisers (by super-k-mer) and of windows, by PACK_BYTES of text."""

    def run(batches):
        for batch in batches:
            lows, own, size = [], [], 0
            for _, words in _groups(batch.column("text")):
                h = words.hashes()
                lows.append(_super_kmers(words, h, window, minimiser, 1, np.zeros(0, np.uint64))[3])
                good = K.within(words.doc, window)
                own.append(K.runs_hash(h, window)[good])
                size += len(words.data)
                if size > PACK_BYTES:
                    yield _counted(lows, own, buckets)
                    lows, own, size = [], [], 0
            if lows:
                yield _counted(lows, own, buckets)

    return K.lean(run)


def _counted(lows: list[np.ndarray], own: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    n, low, many = _frequent(lows, buckets)
    windows, win, times = _frequent(own, buckets)
    return pa.RecordBatch.from_arrays(
        [pa.array([n]), pa.array([low]), pa.array([many]), pa.array([windows]), pa.array([win]), pa.array([times])],
        names=["n", "low", "many", "windows", "win", "times"],
    )


def _examples(window: int, minimum: int, wanted: np.ndarray):
    """The words of wanted windows (by hash, sorted), where ``minimum`` equal ones stand in one group of texts."""

    def run(batches):
        sent: set[int] = set()
        for batch in batches:
            out = []
            for _, words in _groups(batch.column("text")):
                good = K.within(words.doc, window)
                own = K.runs_hash(words.hashes(), window)
                at = np.flatnonzero(_member(own, wanted) & good)
                if not len(at):
                    continue
                order = at[np.argsort(own[at], kind="stable")]
                new = np.flatnonzero(np.diff(own[order], prepend=own[order[0]] ^ np.uint64(1)) != 0)
                size = np.diff(np.append(new, len(order)))
                some = [(a, x) for a, x, n in zip(new.tolist(), own[order[new]].tolist(), size.tolist(), strict=True) if n >= minimum and x not in sent]
                if not some:
                    continue
                tidy, starts, ends = words.tidy()
                flat = tidy.tobytes()
                for a, x in some:
                    found = {flat[starts[i] : ends[i + window - 1]] for i in order[a : a + minimum].tolist()}
                    if len(found) == 1:
                        sent.add(x)
                        out.append((int(np.uint64(x).view(np.int64)), found.pop()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["win", "words"])

    return K.lean(run)


def _member(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Is each value one of the sorted values ``of``?"""
    return of[np.minimum(np.searchsorted(of, x), len(of) - 1)] == x if len(of) else np.zeros(len(x), bool)


def _blobs(found: dict[int, tuple[dict[bytes, int], list]], k1: np.ndarray, k2: np.ndarray, codec: pa.Codec) -> pa.RecordBatch:
    out = []
    for b, (known, places) in found.items():
        p = np.array(places, np.int64)
        head = np.array([len(known), len(p)], np.int64)
        sizes = np.fromiter(map(len, known), np.int64, len(known))
        blob = b"".join((head, sizes, p[:, 0].copy(), k1[p[:, 1]], k2[p[:, 1]], p[:, 2].copy(), *known))
        out.append((b, len(blob), codec.compress(blob, asbytes=True)))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["bucket", "size", "blob"])


def _heavy_places(
    words: K.Words, own: np.ndarray, flat: bytes, starts: np.ndarray, ends: np.ndarray, window: int, heavy: dict[int, bytes], wanted: np.ndarray
) -> np.ndarray:
    """First words of the windows that are a heavy one, byte by byte."""
    at = np.flatnonzero(_member(own, wanted) & K.within(words.doc, window))
    same = [
        flat[lo:hi] == heavy[x]
        for lo, hi, x in zip(starts[at].tolist(), ends[at + window - 1].tolist(), own[at].tolist(), strict=True)
    ]
    return at[np.array(same, bool)]


def _spans(words: K.Words, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and end of the spans that windows at ``at`` (in order) cover; neighbours are one span."""
    row = words.doc[at]
    cut = np.ones(len(at), bool)
    cut[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    a = np.flatnonzero(cut)
    z = np.append(a[1:], len(at)) - 1
    base = words.first[row[a]]
    return row[a], at[a] - base, at[z] + window - base


def _pack(window: int, minimiser: int, buckets: int, heavy: dict[int, bytes], hot: np.ndarray):
    """Texts to one row per (PACK_BYTES of words, bucket): packed strings, and the places they come from.

    The spans of heavy windows go in rows of their own, under a negative number for each group of texts.
    """

    def run(batches):
        codec = pa.Codec("zstd", 3)
        wanted = np.sort(np.fromiter(heavy, np.uint64, len(heavy)))
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in (K1, K2))
            found: dict[int, tuple[dict[bytes, int], list]] = {}
            size = 0
            for a, words in _groups(batch.column("text")):
                h = words.hashes()
                tidy, starts, ends = words.tidy()
                flat = tidy.tobytes()
                at = None
                if heavy:
                    at = _heavy_places(words, K.runs_hash(h, window), flat, starts, ends, window, heavy, wanted)
                    if len(at):
                        row, lo, hi = _spans(words, at, window)
                        blob = np.concatenate((k1[row + a], k2[row + a], lo, hi)).tobytes()
                        to = -1 - int(K.mix(k2[row[:1] + a].view(np.uint64))[0] % np.uint64(buckets))
                        packed = codec.compress(blob, asbytes=True)
                        yield pa.RecordBatch.from_arrays([pa.array([to]), pa.array([len(blob)]), pa.array([packed])], names=["bucket", "size", "blob"])
                first, count, bucket, _ = _super_kmers(words, h, window, minimiser, buckets, hot, at)
                if not len(first):
                    continue
                rows = words.doc[first]
                place_of = first - words.first[rows]
                for lo, hi, b, row, place in zip(
                    starts[first].tolist(), ends[first + count + window - 2].tolist(), bucket.tolist(),
                    (rows + a).tolist(), place_of.tolist(), strict=True,
                ):
                    known, places = found.setdefault(b, ({}, []))
                    places.append((known.setdefault(flat[lo:hi], len(known)), row, place))
                size += len(flat)
                if size > PACK_BYTES:
                    yield _blobs(found, k1, k2, codec)
                    found, size = {}, 0
            if found:
                yield _blobs(found, k1, k2, codec)

    return K.lean(run)


def _same(flat: bytes, lo: np.ndarray, hi: np.ndarray, order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``new`` marks where a sorted hash begins; mark also where equal hashes have unequal bytes.

    Rows of such a group are put in order by their bytes, so that equal windows are neighbours.
    """
    alike = np.flatnonzero(~new)
    a, b = order[alike - 1], order[alike]
    differ = [
        flat[p:q] != flat[r:s]
        for p, q, r, s in zip(lo[a].tolist(), hi[a].tolist(), lo[b].tolist(), hi[b].tolist(), strict=True)
    ]
    if any(differ):
        begins = np.append(np.flatnonzero(new), len(order))
        for g in np.unique(np.searchsorted(begins, alike[np.array(differ)], "right") - 1).tolist():
            x, y = begins[g], begins[g + 1]
            part = sorted(order[x:y].tolist(), key=lambda i: flat[lo[i] : hi[i]])
            order[x:y] = part
            for j in range(1, len(part)):
                p, q = part[j - 1], part[j]
                new[x + j] = flat[lo[p] : hi[p]] != flat[lo[q] : hi[q]]
    return new


def _count_bucket(blobs: list[bytes], window: int, minimum: int):
    """Repeated windows of one bucket as spans of words: K1, K2, first word, end."""
    known: dict[bytes, int] = {}
    which, k1s, k2s, places = [], [], [], []
    for blob in blobs:
        n, m = np.frombuffer(blob, np.int64, 2).tolist()
        head = np.frombuffer(blob, np.int64, n + 4 * m, 16)
        ends = np.cumsum(head[:n]) + 8 * (2 + n + 4 * m)
        ids = np.fromiter(
            (known.setdefault(blob[e - s : e], len(known)) for s, e in zip(head[:n].tolist(), ends.tolist(), strict=True)),
            np.int64, n,
        )
        which.append(ids[head[n : n + m]])
        k1s.append(head[n + m : n + 2 * m])
        k2s.append(head[n + 2 * m : n + 3 * m])
        places.append(head[n + 3 * m :])
    which, k1, k2, place = map(np.concatenate, (which, k1s, k2s, places))
    weight = np.bincount(which, minlength=len(known))
    sizes = np.fromiter(map(len, known), np.int64, len(known))
    flat = b" ".join(known)
    offsets = np.zeros(len(known) + 1, np.int64)
    np.cumsum(sizes + 1, out=offsets[1:])
    data = np.frombuffer(flat + b" ", np.uint8)
    docs, los, his, hashes, first = [], [], [], [], []
    for a, b in K.chunks(offsets):
        words = K.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], K.GRAPHIC)
        i = np.flatnonzero(K.within(words.doc, window))
        hashes.append(K.runs_hash(words.hashes(), window)[i])
        docs.append(words.doc[i] + a)
        los.append(words.starts[i] + offsets[a])
        his.append(words.ends[i + window - 1] + offsets[a])
        first.append(i - words.first[words.doc[i]])
    doc, lo, hi, h, at = map(np.concatenate, (docs, los, his, hashes, first))
    order = np.argsort(h, kind="stable")
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    group = np.cumsum(_same(flat, lo, hi, order, new)) - 1
    total = np.bincount(group, weight[doc[order]])
    again = np.zeros(len(h), bool)
    again[order] = total[group] >= minimum
    # Neighbouring repeated windows of a string are one span.
    i = np.flatnonzero(again)
    if not len(i):
        return None
    cut = np.ones(len(i), bool)
    cut[1:] = (doc[i][1:] != doc[i][:-1]) | (at[i][1:] != at[i][:-1] + 1)
    a = np.flatnonzero(cut)
    z = np.append(a[1:], len(i)) - 1
    span_doc, span_from, span_to = doc[i][a], at[i][a], at[i][z] + window
    # To every place of the string.
    by = np.argsort(which, kind="stable")
    begins = np.searchsorted(which[by], np.arange(len(known) + 1))
    n = weight[span_doc]
    span = np.repeat(np.arange(len(span_doc)), n)
    skip = np.arange(len(span)) - np.repeat(np.cumsum(n) - n, n)
    p = by[begins[span_doc[span]] + skip]
    return k1[p], k2[p], place[p] + span_from[span], place[p] + span_to[span]


def _count(window: int, minimum: int):
    """Rows sorted by bucket to spans; one bucket is held at a time."""

    def run(batches):
        codec, bucket, blobs = pa.Codec("zstd"), None, []

        def done():
            spans = _count_bucket(blobs, window, minimum) if blobs else None
            if spans is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in spans], names=[K1, K2, "lo", "hi"])

        for batch in batches:
            for b, size, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "size", "blob")), strict=True):
                if b < 0:  # spans of heavy windows
                    part = np.frombuffer(codec.decompress(blob, size, asbytes=True), np.int64).reshape(4, -1)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], names=[K1, K2, "lo", "hi"])
                    continue
                if b != bucket:
                    yield from done()
                    bucket, blobs = b, []
                blobs.append(codec.decompress(blob, size, asbytes=True))
        yield from done()

    return K.lean(run)


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, minimiser: int = 5, minimum: int = 2
) -> DataFrame:
    """Spans of words in windows found at ``minimum`` or more places: K1, K2 (row key), lo, hi.

    Spans of one row may overlap or touch. Runs two jobs when called (bytes of text; frequent minimisers and windows), and a third where
    there are heavy windows (their words).
    """
    spark = docs.sparkSession
    ship(spark)
    texts = keyed(docs, id_col, text_col).select(K1, K2, "text")
    _, size = text_bytes(docs, text_col)
    buckets = max(4 * shuffle_partitions(spark), int(size * BLOW_UP / BUCKET_BYTES) + 1)
    local = texts.select("text").mapInArrow(
        _count_minimisers(window, minimiser, buckets),
        "n long, low array<long>, many array<long>, windows long, win array<long>, times array<long>",
    )
    counts = settle(local)
    total, windows = (x or 0 for x in counts.agg(F.sum("n"), F.sum("windows")).first())

    def frequent(value: str, number: str, least: float, most: int | None = None) -> np.ndarray:
        found = (
            counts.select(F.explode(F.arrays_zip(value, number)).alias("x"))
            .groupBy(F.col(f"x.{value}").alias("value")).agg(F.sum(f"x.{number}").alias("n")).filter(F.col("n") > least)
        )
        if most:
            found = found.orderBy(F.desc("n"), "value").limit(most)
        return np.sort(np.array([r[0] for r in found.select("value").collect()], np.int64).view(np.uint64))

    # At most 4 * buckets of either, as each holds that share of all.
    hot = frequent("low", "many", max(total / (4 * buckets), HOT_LEAST))
    often = frequent("win", "times", max(windows / (4 * buckets), HEAVY_LEAST), HEAVY_MOST)
    heavy: dict[int, bytes] = {}
    if len(often):
        examples = settle(texts.select("text").mapInArrow(_examples(window, minimum, often), "win long, words binary"))
        one = examples.groupBy("win").agg(F.min("words").alias("words")).collect()
        heavy = {int(np.int64(r["win"]).view(np.uint64)): bytes(r["words"]) for r in one}
    packed = texts.mapInArrow(_pack(window, minimiser, buckets, heavy, hot), "bucket long, size long, blob binary")
    # Partitions follow the buckets, and each gets its share of them.
    partitions = max(shuffle_partitions(spark), buckets // 4)
    return (
        packed.repartitionById(partitions, F.pmod("bucket", F.lit(partitions)).cast("int")).sortWithinPartitions("bucket")
        .mapInArrow(_count(window, minimum), f"{K1} long, {K2} long, lo long, hi long")
    )


def _remove(keep_text: bool):
    """Texts with spans to counts and what is left."""

    def run(batches):
        for batch in batches:
            spans = batch.column("spans")
            per_row = np.array([len(s) if s is not None else 0 for s in spans.to_pylist()]) if len(spans) else np.zeros(0, int)
            flat = spans.flatten()
            lo, hi = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            begins = np.zeros(len(per_row) + 1, np.int64)
            np.cumsum(per_row, out=begins[1:])
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for a, words in _groups(batch.column("text")):
                b = a + words.n_docs
                tidy, starts, ends = words.tidy()
                change = np.zeros(len(starts) + 1, np.int64)
                x = slice(begins[a], begins[b])
                base = np.repeat(words.first[:-1], per_row[a:b])
                np.add.at(change, base + lo[x], 1)
                np.add.at(change, base + hi[x], -1)
                gone = np.cumsum(change[:-1]) > 0
                left = ~gone
                stay = np.repeat(left, ends - starts + 1)
                flat_kept = tidy[stay].tobytes()
                sizes = np.zeros(len(starts) + 1, np.int64)
                np.cumsum(np.where(left, ends - starts + 1, 0), out=sizes[1:])
                lost = np.zeros(len(starts) + 1, np.int64)
                np.cumsum(gone, out=lost[1:])
                n_words.append(np.diff(words.first))
                n_removed.append(np.diff(lost[words.first]))
                edges = sizes[words.first].tolist()
                parts = [flat_kept[p : max(p, q - 1)] for p, q in zip(edges, edges[1:])]
                if keep_text:
                    kept_texts += [x.decode() for x in parts]
                digests += [hashlib.sha256(x).hexdigest() for x in parts]
            if not n_words:
                continue
            columns = [batch.column("doc_id"), pa.array(np.concatenate(n_words)), pa.array(np.concatenate(n_removed)), pa.array(digests)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                columns, names = [*columns, pa.array(kept_texts)], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return K.lean(run)


def _lists(spans: DataFrame) -> DataFrame:
    """The spans of each row key; rows equal in id and text have the same spans, which count once."""
    return spans.select(K1, K2, "lo", "hi").distinct().groupBy(K1, K2).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, minimiser: int = 5,
    minimum: int = 2, keep_text: bool = True,
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and with ``keep_text`` also kept_text.

    A word goes if a window over it has the same words as another window anywhere, in the same text too.
    Words are runs of other bytes than space and tab to carriage return; kept words are joined by a space.
    A text of fewer words than ``window`` has no window and stays whole; NULL and empty texts have no words.
    Rows that repeat remove each other's windows. Texts come back as rows in no order.
    """
    spans = _lists(repeated_spans(docs, id_col, text_col, window, minimiser, minimum))
    joined = keyed(docs, id_col, text_col).join(spans, [K1, K2], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return joined.mapInArrow(_remove(keep_text), schema)
