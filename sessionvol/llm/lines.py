"""Line dedup by an exact set-similarity join (operator 6).

A line's tokens are its distinct words. Lines of at least ``min_words`` words take part; one goes if a line before it, in order of
document id and place, has a Jaccard similarity of ``threshold`` or more with it. Lines are judged on the input, so a removed line still
removes later ones.

The join. Tokens are put in one order for all lines, rarest first, then by hash. Frequent tokens, those in OFTEN places or more, are counted exactly; the others by hash in
2 ** COUNT_BITS cells, which only orders them. Lines with the same tokens are one class. Two classes of n and m tokens with similarity t share
a token among the first n - ceil(t n) + 1 of either (prefix filter); what comes before their first shared token is in one of
them only (positional filter); n >= t m (length filter). A frequent token is no good key: if the first shared token is one, then so are all
shared tokens, and classes that must share two of them share two among the first n - ceil(t n) + 2; then pairs of frequent tokens are the keys. Classes of LONG tokens or more
have no such pairs but the frequent token together with their length (each length class meets itself and the next), so their keys grow with their tokens only. Every token flips
one of 64 bits of its class, or of 128 if it has LONG tokens; classes that differ in more bits than the sets may are no candidates.

First, small entries without tokens meet by key, and each class with a candidate under a key goes on, once for that key however many candidates it has (under a key of over
HOT classes all go on). Of keys under which the same classes go on only the first one stays. Then these classes meet by key with their tokens, keys of over BLOCK classes in tiles of two blocks, and every pair is verified under the first key that
it shares, by a product of token matrices. What comes out is a row for each class: its number of links, and whether an earlier class is similar. No pair is ever a row.

Tokens are compared by 40 bits of a hash: two words of one pair of lines are taken for each other in about one of 10 ** 12 cases. At scale: classes instead of copies are joined, so groups
of copies cost one entry per batch; entries go in packed blocks to buckets whose number follows the bytes of the table. The list of frequent tokens is at most 2 ** FREQUENT_BITS
long, as each holds so large a share of all words at least. Only the places of kept lines are joined to the texts that lose some.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import counting
from sessionvol.llm import kernels as K
from sessionvol.llm.rows import K1, K2, keyed, row_key, ship, shuffle_partitions
from sessionvol.plans.joins import lookup_join
from sessionvol.session import folder_mark, folders_since, new_folder, remove_folders, settle

COUNT_BITS = 20
#: Places from which on a token is frequent; in a very large corpus the 2 ** FREQUENT_BITS-th part of all words, if that is more.
OFTEN, FREQUENT_BITS = 1024, 20
#: Bytes of entries in a bucket, and entries' bytes per byte of text.
BUCKET_BYTES, SHARE = 16 << 20, 0.8
#: Tokens of a class from which on it has a second word of bits, and no pairs of tokens as keys.
LONG = 64
#: Classes of a key that are compared for candidates; under larger keys all are candidates.
HOT = 4096
#: Classes that are compared by one matrix.
FEW = 128
#: Classes of a block of a key, and pairs that a task compares at a time.
BLOCK, PAIRS = 16384, 1 << 20
#: Classes with a candidate, and documents that lose lines, that are sent to all tasks rather than joined by shuffle.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20
_LAST = np.iinfo(np.int64).max
_HASH = np.uint64((1 << 40) - 1)
_FREQUENT = 2  # name of frequent tokens among the counts that tasks send


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the sum of the counts of each."""
    h, n = np.concatenate(hashes), np.concatenate(counts)
    if not len(h):
        return h, n
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    new = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    return h[new], np.add.reduceat(n, new)


@K.lean
def _count(batches):
    """Texts to words by cell (0), bytes (1), and tokens that may be frequent (_FREQUENT, by the first byte of their hash)."""
    counts, size = np.zeros(1 << COUNT_BITS, np.int64), np.zeros(1, np.int64)
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[np.ndarray] = []

    def count_held():
        h = np.concatenate(held)
        counts[:] += np.bincount(_cells(h), minlength=len(counts))
        token, n = np.unique(h, return_counts=True)
        # A token of a frequent one's share is so often in one chunk of words at least.
        use = n >= max(min(2, OFTEN), len(h) >> FREQUENT_BITS)
        seen.append((token[use], n[use].astype(np.int64)))
        if sum(len(t) for t, _ in seen) > 1 << 22:
            seen[:] = [_summed(*map(list, zip(*seen)))]
        held.clear()

    for batch in batches:
        data, offsets = K.buffer(batch.column("text"))
        size += len(data)
        for a, b in K.chunks(offsets):
            held.append(K.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], K.GRAPHIC).hashes())
            if sum(map(len, held)) > 1 << 21:
                count_held()
    if held:
        count_held()
    yield from counting.send({0: counts, 1: size})
    if seen:
        token, n = _summed(*map(list, zip(*seen)))
        edges = np.searchsorted(token >> np.uint64(56), np.arange(257, dtype=np.uint64))
        some = [k for k in range(256) if edges[k] < edges[k + 1]]
        parts = [slice(edges[k], edges[k + 1]) for k in some]
        columns = [[_FREQUENT] * len(some), some, [token[p].tobytes() for p in parts], [n[p].astype(np.int32).tobytes() for p in parts]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["name", "slice", "at", "n"])


def _frequent(often: int):
    """Counts of possible frequent tokens to those that are."""

    def run(batches):
        parts: dict[int, list] = {}
        for batch in batches:
            for part, at, n in zip(*(batch.column(c).to_pylist() for c in ("slice", "at", "n"))):
                parts.setdefault(part, []).append((np.frombuffer(at, np.uint64), np.frombuffer(n, np.int32).astype(np.int64)))
        for found in parts.values():
            token, n = _summed(*map(list, zip(*found)))
            use = n >= often
            yield pa.RecordBatch.from_arrays([pa.array([token[use].tobytes()]), pa.array([n[use].tobytes()])], names=["token", "n"])

    return K.lean(run)


def _rank(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, (np.log2(np.maximum(counts, 1)) * 6).astype(np.int64) + 1)


class Order:
    """The order of all tokens: a code's highest byte is the rank of its count, the rest its hash."""

    def __init__(self, cells: np.ndarray, tokens: np.ndarray, counts: np.ndarray, often: int):
        by = np.argsort(tokens)
        self.tokens = tokens[by]
        rest = cells.copy()
        np.subtract.at(rest, _cells(self.tokens), counts[by])
        self.often = int(_rank(np.array([often]))[0])
        self.rare = np.minimum(_rank(rest), self.often - 1).astype(np.uint8)
        self.ranks = np.maximum(_rank(counts[by]), self.often).astype(np.uint8)

    def codes(self, h: np.ndarray) -> np.ndarray:
        rank = self.rare[_cells(h)]
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, h), len(self.tokens) - 1)
            hit = self.tokens[at] == h
            rank = np.where(hit, self.ranks[at], rank)
        return (rank.astype(np.uint64) << np.uint64(40)) | (h & _HASH)

    def is_rare(self, codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(40)) < np.uint64(self.often)


class Lines:
    """Lines of a group of texts: row, number in the text, first and last word, and for lines that take part the codes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, min_words: int):
        self.words = words = K.Words(data, offsets, K.GRAPHIC)
        ends = np.flatnonzero(data == 0x0A)
        # A word's line: line ends before it, with those before its text taken off.
        self.breaks = np.searchsorted(ends, words.starts)
        self.before = np.searchsorted(ends, offsets[:-1])
        cut = np.ones(len(words.starts), bool)
        cut[1:] = (self.breaks[1:] != self.breaks[:-1]) | (words.doc[1:] != words.doc[:-1])
        self.first = np.flatnonzero(cut)
        self.size = np.diff(np.append(self.first, len(cut)))
        self.row = words.doc[self.first]
        self.number = self.breaks[self.first] - self.before[self.row]
        self.part = self.size >= min_words

    def codes(self, order: Order) -> tuple[np.ndarray, np.ndarray]:
        """Ordered distinct codes of the lines that take part, one after the other, and where each line begins."""
        lines = np.flatnonzero(self.part)
        of = np.repeat(np.arange(len(self.first)), self.size)
        take = self.part[of]
        of = of[take]
        h = self.words.hashes()[take]
        code = order.codes(h)
        place = np.zeros(len(self.first), np.int64)
        place[lines] = np.arange(len(lines))
        out, begins = [], []
        # Sixteen bits name the line, so that one sort orders all.
        lengths = self.size[lines]
        edges = np.zeros(len(lines) + 1, np.int64)
        np.cumsum(lengths, out=edges[1:])
        done = 0
        for a in range(0, len(lines), 1 << 16):
            b = min(a + (1 << 16), len(lines))
            local = (place[of[edges[a] : edges[b]]] - a).astype(np.uint64) << np.uint64(48)
            key = np.sort(local | code[edges[a] : edges[b]])
            key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
            begins.append(np.searchsorted(key, np.arange(b - a, dtype=np.uint64) << np.uint64(48)) + done)
            out.append(key & np.uint64((1 << 48) - 1))
            done += len(key)
        codes = np.concatenate(out) if out else np.zeros(0, np.uint64)
        return codes, np.append(np.concatenate(begins) if begins else np.zeros(0, np.int64), done).astype(np.int64)


_LINES = f"{K1} long, {K2} long, doc_id long, line int, s1 long, s2 long, n int, bits long, bits2 long, codes binary, of int"


def _lines(order, min_words: int):
    """Texts to their lines; the codes are given at the first line of each class in a batch only."""

    def run(batches):
        for batch in batches:
            data, offsets = K.buffer(batch.column("text"))
            parts = []
            for a, b in K.chunks(offsets, 4 * K.CHUNK):
                lines = Lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], min_words)
                codes, at = lines.codes(order.value)
                if len(at) < 2:
                    continue
                m = K.mix(codes)
                n, rows = np.diff(at), lines.row[lines.part]
                flip = np.uint64(1) << (m >> np.uint64(58))
                second = (m >> np.uint64(57)) & np.uint64(1) > 0
                second &= np.repeat(n >= LONG, n)
                parts.append((
                    rows + a, lines.number[lines.part].astype(np.int32), np.add.reduceat(m, at[:-1]),
                    np.add.reduceat(K.mix(m ^ np.uint64(0x5851F42D4C957F2D)), at[:-1]), n.astype(np.int32),
                    np.bitwise_xor.reduceat(np.where(second, np.uint64(0), flip), at[:-1]),
                    np.bitwise_xor.reduceat(np.where(second, flip, np.uint64(0)), at[:-1]),
                    np.bincount(rows, minlength=b - a)[rows].astype(np.int32), codes,
                ))
            if not parts:
                continue
            row, number, s1, s2, n, bits, more, of, codes = map(np.concatenate, zip(*parts))
            del parts
            doc = batch.column("doc_id").fill_null(_LAST).to_numpy()[row]
            by = np.lexsort((number, doc, s2, s1))
            first = np.zeros(len(s1), bool)
            first[by[np.append(True, (s1[by][1:] != s1[by][:-1]) | (s2[by][1:] != s2[by][:-1]))]] = True
            six = np.ascontiguousarray(codes[np.repeat(first, n)].view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
            at = np.zeros(len(n) + 1, np.int32)
            np.cumsum(np.where(first, n, 0) * 6, out=at[1:])
            blobs = pa.Array.from_buffers(pa.binary(), len(n), [pa.array(first).buffers()[1], pa.py_buffer(at), pa.py_buffer(six)])
            keys = [batch.column(c).take(pa.array(row)) for c in (K1, K2, "doc_id")]
            numbers = [pa.array(x.view(np.int64)) for x in (s1, s2)], [pa.array(x.view(np.int64)) for x in (bits, more)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(number), *numbers[0], pa.array(n), *numbers[1], blobs, pa.array(of)],
                names=[K1, K2, "doc_id", "line", "s1", "s2", "n", "bits", "bits2", "codes", "of"],
            )

    return K.lean(run)


def _wide(six: np.ndarray) -> np.ndarray:
    out = np.zeros((len(six) // 6, 8), np.uint8)
    out[:, :6] = six.reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


#: Fields of an entry: key, class, two words of bits, tokens, place of the (first) token, and the kind of key: 0 a single token, k > 0 a token and the one k places on,
#: OWN and NEXT a token with the length class of its class and with the one above.
_ENTRY = {"code": "<u4", "s1": "<i8", "bits": "<u8", "bits2": "<u8", "n": "<u4", "at": "<u4", "step": "<i4"}
OWN, NEXT = -1, -2


def _planes(column: np.ndarray) -> bytes:
    """A column byte by byte, which compresses better."""
    return np.ascontiguousarray(column.view(np.uint8).reshape(len(column), -1).T).tobytes()


def _columns(raw: bytes, n: int, fields: dict[str, str]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, kind in fields.items():
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out[name] = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        at += n * size
    return out


def _shared_at_least(n, m, threshold: float):
    """Tokens that sets of n and m share if they are similar."""
    return np.ceil(threshold / (1 + threshold) * (n + m) - 1e-9).astype(np.int64)


def _length_class(n: np.ndarray, threshold: float) -> np.ndarray:
    """Similar sets are in one length class or in two that follow each other."""
    edges, most = [1], int(n.max(initial=1))
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, int(np.ceil(edges[-1] / threshold - 1e-9))))
    return np.searchsorted(edges, n, "right")


def _entries(codes: np.ndarray, begin: np.ndarray, n: np.ndarray, threshold: float, order: Order):
    """Keys of all classes: line, key, place of its (first) token, kind."""
    prefix = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
    reach = np.minimum(prefix + 1, n)  # the prefix that shares two tokens
    line = np.repeat(np.arange(len(n)), reach)
    at = np.arange(len(line)) - np.repeat(np.cumsum(reach) - reach, reach)
    code = codes[begin[line] + at]
    rare = order.is_rare(code)
    short = n[line] < LONG
    one = _shared_at_least(n, np.ceil(threshold * n - 1e-9), threshold) <= 1  # sets that may be similar by one token
    single = (at < prefix[line]) & (rare | (short & one[line]))
    lines, keys, places, kinds = [line[single]], [code[single]], [at[single]], [np.zeros(int(single.sum()), np.int64)]
    i = np.flatnonzero(short & ~rare)
    step = 1
    while len(i):  # pairs of frequent tokens of one line, by their distance
        i = i[i + step < len(line)]
        i = i[line[i + step] == line[i]]
        lines.append(line[i])
        keys.append(K.mix(code[i] * np.uint64(0x9E3779B97F4A7C15) + code[i + step]) | np.uint64(1 << 63))
        places.append(at[i])
        kinds.append(np.full(len(i), step))
        step += 1
    # Frequent tokens of sets that have LONG tokens, or may be similar to one that has.
    far = np.flatnonzero(~rare & (n[line] >= threshold * LONG - 1e-9) & (at < prefix[line]))
    if len(far):
        length = _length_class(n, threshold)[line[far]]
        for kind, up in ((OWN, 0), (NEXT, 1)):
            lines.append(line[far])
            keys.append(K.mix(code[far] * np.uint64(0xD6E8FEB86659FD93) + (length + up).astype(np.uint64)) >> np.uint64(1) | np.uint64(1 << 62))
            places.append(at[far])
            kinds.append(np.full(len(far), kind))
    return tuple(map(np.concatenate, (lines, keys, places, kinds)))


def _first_of_batch(batch: pa.RecordBatch) -> np.ndarray:
    """Rows of the first place of each class in a batch."""
    s1, number = batch.column("s1").to_numpy(), batch.column("line").to_numpy()
    doc = batch.column("doc_id").fill_null(_LAST).to_numpy()
    by = np.lexsort((number, doc, s1))
    return np.sort(by[np.append(True, s1[by][1:] != s1[by][:-1])]) if len(s1) else by


def _deal(threshold: float, buckets: int, order):
    """Lines to packed entries, one row per (batch, bucket)."""

    def run(batches):
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            batch = batch.filter(batch.column("codes").is_valid())
            if not len(batch):
                continue
            part = batch.take(pa.array(_first_of_batch(batch)))
            data, offsets = K.buffer(part.column("codes"))
            n = part.column("n").to_numpy().astype(np.int64)
            line, key, at, step = _entries(_wide(data), offsets[:-1] // 6, n, threshold, order.value)
            mixed = K.mix(key)
            bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            line, bucket = line[by], bucket[by]
            entries = {
                "code": mixed[by].astype(np.uint32),  # keys of one bucket that agree in 32 bits only meet more classes
                "s1": part.column("s1").to_numpy()[line], "bits": part.column("bits").to_numpy().view(np.uint64)[line],
                "bits2": part.column("bits2").to_numpy().view(np.uint64)[line],
                "n": n[line].astype(np.uint32), "at": at[by].astype(np.uint32), "step": step[by].astype(np.int32),
            }
            edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else [0]
            out = []
            for a, b in zip(edges[:-1], edges[1:]):
                blob = b"".join(_planes(column[a:b]) for column in entries.values())
                out.append((int(bucket[a]), int(b - a), codec.compress(blob, asbytes=True)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["bucket", "n", "blob"])

    return K.lean(run)


def _live(blobs: list[tuple[int, bytes]], threshold: float):
    """Of one bucket: entries that have a candidate under their key (code, s1, at, step), how many these are under that key, and of each key's
    entries: two fingerprints, the order of the key among the tokens of its smallest class, and which entry is that class's."""
    codec = pa.Codec("zstd")
    size = sum(np.dtype(k).itemsize for k in _ENTRY.values())
    parts = [_columns(codec.decompress(blob, n * size, asbytes=True), n, _ENTRY) for n, blob in blobs]
    e = {f: np.concatenate([p[f] for p in parts]) for f in _ENTRY}
    del parts
    # One sort by key and half of the class; whole classes only where halves agree.
    joint = (e["code"].astype(np.uint64) << np.uint64(32)) | (e["s1"].view(np.uint64) & np.uint64(0xFFFFFFFF))
    by = np.argsort(joint)
    code, s1 = e["code"][by], e["s1"][by]
    halves = (code[1:] == code[:-1]) & (s1[1:] != s1[:-1]) & (joint[by][1:] == joint[by][:-1])
    if halves.any():
        by = np.lexsort((e["s1"], e["code"]))
        code, s1 = e["code"][by], e["s1"][by]
    del joint
    new = np.append(True, (code[1:] != code[:-1]) | (s1[1:] != s1[:-1]))  # a class once for a key
    by, code = by[new], code[new]
    begins = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    length = np.diff(np.append(begins, len(code)))
    by = by[np.repeat(length > 1, length)]  # a class alone under its key is done
    length = length[length > 1]
    if not len(by):
        return None
    code, s1, bits, bits2, n, at, step = (e[f][by] for f in _ENTRY)
    del e
    n, at = n.astype(np.int64), at.astype(np.int64)
    unshared = at + np.maximum(step - 1, 0)
    long = n >= LONG
    end = np.repeat(np.cumsum(length), length)
    live = np.repeat(length > HOT, length)
    group = np.repeat(np.arange(len(length)), length)
    i = np.flatnonzero(~live)
    far = 1
    while len(i):
        i = i[i + far < end[i]]
        x = i[~(live[i] & live[i + far])]
        y = x + far
        total = n[x] + n[y]
        limit = total - 2 * _shared_at_least(n[x], n[y], threshold)  # tokens that may differ
        good = (np.abs(n[x] - n[y]) <= limit) & (unshared[x] + unshared[y] <= limit) & ((step[x] != NEXT) | (step[y] != NEXT))
        x, y, limit = x[good], y[good], limit[good]
        off = np.bitwise_count(bits[x] ^ bits[y]).astype(np.int64)
        # Only classes that both have a second word are compared in it; else both words together say less.
        mixed = np.bitwise_count(bits[x] ^ bits2[x] ^ bits[y] ^ bits2[y])
        off = np.where(long[x] & long[y], off + np.bitwise_count(bits2[x] ^ bits2[y]), mixed)
        good = off <= limit
        live[x[good]] = live[y[good]] = True
        far += 1
        if far % 32 == 0:  # keys whose classes all have one are done
            open_groups = np.bincount(group[~live], minlength=len(length)) > 0
            i = i[open_groups[group[i]]]
    code, s1, at, step, group = (v[live] for v in (code, s1, at, step, group))
    if not len(code):
        return None
    new = np.append(True, group[1:] != group[:-1])
    begins = np.flatnonzero(new)
    many = np.diff(np.append(begins, len(group)))
    which = np.cumsum(new) - 1
    kind = np.where(step > 0, 1, np.where(step < 0, 1 - step, 0)).astype(np.uint64)
    each = K.mix(s1.view(np.uint64) ^ (kind << np.uint64(62)))
    prints = [np.add.reduceat(K.mix(each ^ np.uint64(salt)), begins).view(np.int64)[which] for salt in (0x9FB21C651E98DF25, 0xD8F2A1B3C4E5F607)]
    place = (at[begins] << np.int64(31)) + np.maximum(step[begins], 0)  # entries of a key are in the order of their classes
    return code, s1, at, step, many[which], *prints, place[which], new


def _candidates(threshold: float):
    """Buckets to live entries: key, s1, at, step, m (live classes under the key), and what _live says of the key."""

    def run(batches):
        bucket, blobs = None, []

        def done():
            found = _live(blobs, threshold) if blobs else None
            if found:
                code, s1, at, step, many, print1, print2, place, lead = found
                key = (np.int64(bucket) << np.int64(32)) | code.astype(np.int64)
                columns = (key, s1, at.astype(np.int32), step.astype(np.int32), many.astype(np.int64), print1, print2, place, lead)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["key", "s1", "at", "step", "m", "print1", "print2", "place", "lead"])

        for batch in batches:
            for b, n, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n", "blob"))):
                if b != bucket:
                    yield from done()
                    bucket, blobs = b, []
                blobs.append((n, blob))
        yield from done()

    return K.lean(run)


class Tile:
    """Classes of one key, or of two of its blocks: their codes and what comes before (or between) the key's tokens."""

    def __init__(self, codes: list[np.ndarray], at: np.ndarray, step: np.ndarray, rank: np.ndarray, threshold: float):
        self.codes, self.at, self.step, self.rank, self.threshold = codes, at, step, rank, threshold
        self.n = np.array([len(c) for c in codes])
        self.links, self.later = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)

    def _early(self, r: int) -> np.ndarray:
        code, at, step = self.codes[r], self.at[r], self.step[r]
        return np.concatenate([code[:at], code[at + 1 : at + step]]) if step > 0 else code[:at]

    def _having(self, rows: np.ndarray, token) -> np.ndarray:
        return np.array([token in self._early(r) for r in rows.tolist()], bool)

    def _split(self, x: np.ndarray, y: np.ndarray, same: bool, depth: int = 3):
        """Parts of the pairs x by y (or of x, ``same``) without those that share a common early token: they meet under another key."""
        rows = x if same else np.concatenate([x, y])
        early = [self._early(r) for r in rows.tolist()] if depth and len(rows) >= 64 else []
        flat = np.concatenate(early) if early else np.zeros(0, np.uint64)
        token, n = np.unique(flat, return_counts=True)
        if not len(token) or 2 * n.max() < len(rows):
            yield x, y, same
            return
        token = token[np.argmax(n)]
        has_x = self._having(x, token)
        if same:
            yield from self._split(x[~has_x], x[~has_x], True, depth - 1)
            yield from self._split(x[~has_x], x[has_x], False, depth - 1)
        else:
            has_y = self._having(y, token)
            yield from self._split(x[~has_x], y, False, depth - 1)
            yield from self._split(x[has_x], y[~has_y], False, depth - 1)

    def _strips(self, rows: np.ndarray, most: int, tokens: int):
        """Rows in parts of at most so many rows, and of about so many tokens."""
        low, total = 0, np.cumsum(self.n[rows])
        while low < len(rows):
            high = int(np.searchsorted(total, (total[low - 1] if low else 0) + tokens, "right"))
            high = min(max(high, low + 1), low + most, len(rows))
            yield rows[low:high]
            low = high

    @staticmethod
    def _shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Number of codes that each of ``a`` shares with each of ``b``."""
        fa, fb = np.concatenate(a), np.concatenate(b)
        words = np.intersect1d(fa, fb)
        out = np.zeros((len(a), len(b)), np.float32)
        row_a, row_b = (np.repeat(np.arange(len(v)), [len(c) for c in v]) for v in (a, b))
        for k in range(0, len(words), 2048):
            part = words[k : k + 2048]
            sides = []
            for flat, row, size in ((fa, row_a, len(a)), (fb, row_b, len(b))):
                place = np.minimum(np.searchsorted(part, flat), len(part) - 1)
                hit = part[place] == flat
                side = np.zeros((size, len(part)), np.float32)
                side[row[hit], place[hit]] = 1
                sides.append(side)
            out += sides[0] @ sides[1].T
        return out

    def compare_few(self, rows: np.ndarray, frequent: bool) -> None:
        """``compare`` within a few rows, with one matrix for all."""
        flat = np.concatenate([self.codes[r] for r in rows.tolist()])
        n = self.n[rows]
        row, words = np.repeat(np.arange(len(rows)), n), np.unique(flat, return_inverse=True)[1]
        side = np.zeros((len(rows), int(words.max()) + 1), np.float32)
        side[row, words] = 1
        link = self._linked(side @ side.T, rows, rows, frequent)
        link &= np.arange(len(rows))[:, None] < np.arange(len(rows))[None, :]
        if link.any():
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            at, step = self.at[rows][row], self.step[rows][row]
            late = (place >= at) & ((step <= 0) | (place == at) | (place >= at + step))
            side[row[late], words[late]] = 0
            link &= side @ side.T == 0
            self._note(link, rows, rows)

    def compare(self, x: np.ndarray, y: np.ndarray, same: bool, frequent: bool) -> None:
        """Verify the pairs of rows x by y, or those within x, whose first shared key this is."""
        if same and len(x) <= FEW and int(self.n[x].sum()) * len(x) <= 1 << 20:
            self.compare_few(x, frequent)
            return
        for x, y, same in self._split(x, y, same):
            x, y = x[np.argsort(self.n[x], kind="stable")], y[np.argsort(self.n[y], kind="stable")]
            side = max(1, int(PAIRS**0.5))
            for a in self._strips(x, max(1, side // 2), 1 << 16):
                for b in self._strips(y, 2 * side, 1 << 18):
                    if self.n[b].min() > self.n[a].max() / self.threshold + 1e-6 or self.n[b].max() < self.threshold * self.n[a].min() - 1e-6:
                        continue
                    self._verify(a, b, same, frequent)

    def _linked(self, shared: np.ndarray, a: np.ndarray, b: np.ndarray, frequent: bool) -> np.ndarray:
        """Are sets with so many shared codes similar, and may they meet under a key of this kind?"""
        n, m = self.n[a][:, None], self.n[b][None, :]
        link = shared >= self.threshold * (n + m - shared) - 1e-6
        kind_a, kind_b = self.step[a][:, None], self.step[b][None, :]
        if (self.step[a] < 0).any():
            link &= (np.maximum(n, m) >= LONG) & ((kind_a != NEXT) | (kind_b != NEXT))
        elif frequent or (self.step[a] > 0).any():
            link &= (_shared_at_least(n, m, self.threshold) >= 2) == (kind_a > 0)
        return link

    def _note(self, link: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        rank_a, rank_b = self.rank[a][:, None], self.rank[b][None, :]
        np.add.at(self.links, a, link.sum(axis=1))
        np.add.at(self.links, b, link.sum(axis=0))
        self.later[a] |= (link & (rank_b < rank_a)).any(axis=1)
        self.later[b] |= (link & (rank_a < rank_b)).any(axis=0)

    def _verify(self, a: np.ndarray, b: np.ndarray, same: bool, frequent: bool) -> None:
        shared = self._shared([self.codes[r] for r in a.tolist()], [self.codes[r] for r in b.tolist()])
        link = self._linked(shared, a, b, frequent)
        if same:
            link &= a[:, None] < b[None, :]
        if not link.any():
            return
        early_a, early_b = [self._early(r) for r in a.tolist()], [self._early(r) for r in b.tolist()]
        if sum(map(len, early_a)) and sum(map(len, early_b)):
            link &= self._shared(early_a, early_b) == 0
        self._note(link, a, b)


_TILE = f"key long, x int, y int, block int, s1 long, s2 long, at int, step int, unknown boolean, doc_id long, {K2} long, line int, codes binary"
_LIVE = "key long, s1 long, at int, step int, m long, print1 long, print2 long, place long, lead boolean"
_FOUND = "s1 long, s2 long, n long, later boolean"


def _verify_tiles(threshold: float, order):
    """Tiles to their classes that have a link: how many, and whether one to an earlier class."""

    def run(batches):
        found, held = [], 0
        for table, edges in K.tiles(batches):
            data, offsets = K.buffer(table.column("codes"))
            wide, ends = _wide(data), (offsets // 6).tolist()
            codes = [wide[a:b] for a, b in zip(ends, ends[1:])]
            at, step, block, line, xs, ys = (table.column(c).to_numpy().astype(np.int64) for c in ("at", "step", "block", "line", "x", "y"))
            place = [line, table.column(K2).to_numpy(), table.column("doc_id").combine_chunks().fill_null(0).to_numpy(), table.column("unknown").to_numpy()]
            rank = np.empty(len(codes), np.int64)
            rank[np.lexsort(place)] = np.arange(len(codes))
            first = wide[np.array(ends[:-1], np.int64) + at]  # the (first) token of the key
            second = wide[np.array(ends[:-1], np.int64) + at + np.maximum(step, 0)]
            common = ~order.value.is_rare(first)
            tiles = Tile(codes, at, step, rank, threshold)
            for lo, hi in zip(edges, edges[1:]):
                x, y = int(xs[lo]), int(ys[lo])
                groups = [np.arange(lo, hi)]
                kind = np.sign(step[lo:hi]) if (first[lo:hi] != first[lo]).any() or (second[lo:hi] != second[lo]).any() or (np.sign(step[lo:hi]) != np.sign(step[lo])).any() else None
                if kind is not None:  # different keys have met under one code
                    names = np.stack([first[lo:hi].astype(np.int64), second[lo:hi].astype(np.int64), kind])
                    which = np.unique(names, axis=1, return_inverse=True)[1].reshape(-1)
                    groups = [lo + np.flatnonzero(which == k) for k in range(which.max() + 1)]
                for rows in groups:
                    of_x, of_y = (rows, rows) if x == y else (rows[block[rows] == x], rows[block[rows] == y])
                    if len(of_x) and len(of_y) and (x != y or len(rows) > 1):
                        tiles.compare(of_x, of_y, x == y, bool(common[rows[0]]))
            some = np.flatnonzero(tiles.links)
            if len(some):
                s1, s2 = (table.column(c).to_numpy()[some] for c in ("s1", "s2"))
                found.append((s1, s2, tiles.links[some], tiles.later[some]))
                held += len(some)
            if held > 1 << 16:
                yield _found(found)
                found, held = [], 0
        if found:
            yield _found(found)

    return K.lean(run)


def _found(parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*parts)], names=["s1", "s2", "n", "later"])


def _stored(df: DataFrame) -> DataFrame:
    path = new_folder(df.sparkSession, "lines")
    # Codes and hashes hardly repeat: looking for repeats only costs time.
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in ("codes", "s1", "s2", "bits", "bits2")}
    df.write.options(compression="zstd", **plain).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _token_order(texts: DataFrame) -> tuple[Order, int]:
    """The order of all tokens, and the bytes of all texts. The driver gets 2 ** COUNT_BITS cells and at most 2 ** FREQUENT_BITS tokens, whatever the input."""
    sent = settle(texts.select("text").mapInArrow(_count, counting.SENT))
    found = counting.total(sent.filter(F.col("name") < _FREQUENT), {0: 1 << COUNT_BITS, 1: 1})
    often = max(OFTEN, int(found[0].sum()) >> FREQUENT_BITS)
    rows = sent.filter(F.col("name") == _FREQUENT).repartition("slice").mapInArrow(_frequent(often), "token binary, n binary").collect()
    tokens = np.concatenate([np.frombuffer(r[0], np.uint64) for r in rows] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([np.frombuffer(r[1], np.int64) for r in rows] or [np.zeros(0, np.int64)])
    return Order(found[0], tokens, counts, often), int(found[1][0])


def judged_classes(docs: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, min_words: int = 5) -> tuple[DataFrame, DataFrame]:
    """Lines that take part (K1, K2, ...), and their classes: s1, s2, first (place of the first line), stays, n_links (other classes that a class is similar to).
    Runs jobs when called."""
    spark = docs.sparkSession
    ship(spark)
    texts = keyed(docs, id_col, text_col)
    order, size = _token_order(texts)
    order = spark.sparkContext.broadcast(order)
    mark = folder_mark()
    lines = _stored(texts.mapInArrow(_lines(order, min_words), _LINES))
    folder = folders_since(mark)[0]
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", K2, "line")
    classes = settle(lines.groupBy("s1", "s2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places")))
    buckets = max(4 * shuffle_partitions(spark), int(size * SHARE / BUCKET_BYTES) + 1)

    rows = lines.filter("codes is not null").select("s1", "doc_id", "line", "n", "bits", "bits2", "codes")
    dealt = rows.mapInArrow(_deal(threshold, buckets, order), "bucket long, n long, blob binary")
    live = settle(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_candidates(threshold), _LIVE))
    # Of keys with the same classes the first one is enough: all pairs under the others share its tokens, too.
    groups = live.filter("lead").groupBy("m", "print1", "print2").agg(F.min(F.struct("place", "key")).alias("first"))
    live = lookup_join(live.select("key", "s1", "at", "step", "m"), groups.select(F.col("first.key").alias("key")), ["key"], "inner", spread=("s1",))
    live = settle(live)
    ids = settle(live.select("s1").distinct())
    some = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    held = lines.filter("codes is not null").select("s1", "s2", "codes").join(some, "s1", "left_semi").dropDuplicates(["s1", "s2"])
    held = settle(held.join(classes, ["s1", "s2"]).select("s1", "s2", "codes", "first.*"))
    slim = _stored(lines.select(K1, K2, "doc_id", "line", "s1", "s2", "of"))
    remove_folders(spark, folder)  # the codes of all other classes
    lines = slim
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    tiles = live.join(held, "s1").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("s1", "s2"), "blocks").cast("int"))
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")}).select(*[c.split(" ")[0] for c in _TILE.split(", ")])
    dealt = tiles.repartition(shuffle_partitions(spark), "key", "x", "y").sortWithinPartitions("key", "x", "y")
    links = dealt.mapInArrow(_verify_tiles(threshold, order), _FOUND)
    links = links.groupBy("s1", "s2").agg(F.sum("n").alias("n_links"), F.max("later").alias("later"))
    judged = classes.join(settle(links), ["s1", "s2"], "left")
    return lines, judged.withColumn("stays", ~F.coalesce("later", F.lit(False))).withColumn("n_links", F.coalesce("n_links", F.lit(0))).drop("later")


def _lines_with_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of lines with a word of each text."""
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    begins = np.zeros(len(data), bool)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    begins[1:] |= data[:-1] == 0x0A
    begins = np.flatnonzero(begins)
    some = np.logical_or.reduceat(K.GRAPHIC[data], begins)
    return np.diff(np.searchsorted(begins[some], offsets))


def _apply(text_col: str, out):
    """Each text without its lost lines to ``out`` of the batch, the texts, the number of lines and the removed ones."""

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            data, offsets = K.buffer(column)
            lost = batch.column(batch.schema.get_field_index("__llm_gone")).to_pylist()
            n_lines, removed, texts = [], [], []
            for a, b in K.chunks(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                flat, ends = part.tobytes(), at.tolist()
                n_lines += _lines_with_words(part, at).tolist()
                for r in range(b - a):
                    raw, gone = flat[ends[r] : ends[r + 1]], set()
                    if lost[a + r]:
                        gone = set(lost[a + r])
                        raw = b"\n".join(t for k, t in enumerate(raw.split(b"\n")) if k not in gone)
                    removed.append(sorted(gone))
                    texts.append(raw)
            yield out(batch.drop_columns(["__llm_gone"]), texts, n_lines, removed)

    return K.lean(run)


def _digest(batch, texts, n_lines, removed):
    digests = [hashlib.sha256(t).hexdigest() for t in texts]
    columns = [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(list(map(len, removed)), pa.int64())]
    columns += [pa.array(removed, pa.list_(pa.int32())), pa.array(digests, pa.string())]
    names = ["doc_id", "n_lines", "n_removed", "removed", "kept_sha256"]
    if "n_links" in batch.schema.names:
        columns, names = [*columns, batch.column("n_links")], [*names, "n_links"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _replace(text_col: str):
    def out(batch, texts, n_lines, removed):
        at = batch.schema.get_field_index(text_col)
        texts = [t.decode(errors="replace") if there else None for t, there in zip(texts, batch.column(at).is_valid().to_pylist())]
        batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
        return batch.filter(pa.array([not n or len(gone) < n for n, gone in zip(n_lines, removed)], pa.bool_()))

    return out


def _lost(lines: DataFrame, judged: DataFrame) -> DataFrame:
    """Rows that lose lines or have links: __llm_r1, __llm_r2 (the row key), __llm_gone (numbers of the lines that go), __llm_links."""
    some = judged.filter("places > 1 OR NOT stays OR n_links > 0").select(
        "s1", "s2", "stays", "n_links", F.col("first.doc_id").alias("first_doc"), F.col(f"first.{K2}").alias("first_k2"), F.col("first.line").alias("first_line")
    )
    marked = lookup_join(lines, some, ["s1", "s2"], "left", spread=(K1, K2, "line"))
    first = F.col("first_doc").eqNullSafe(F.col("doc_id")) & (F.col("first_k2") == F.col(K2)) & (F.col("first_line") == F.col("line"))
    found = marked.groupBy(K1, K2).agg(
        F.collect_set(F.when(F.col("stays").isNotNull() & ~(F.col("stays") & first), F.col("line"))).alias("gone"),
        F.sum("n_links").alias("links"), F.max("of").alias("of"), F.count(F.lit(1)).alias("rows"),
    )
    # Rows equal in id and text have all their lines under one row key.
    links = F.coalesce(F.expr("links * of div rows"), F.lit(0))
    found = found.select(F.col(K1).alias("__llm_r1"), F.col(K2).alias("__llm_r2"), F.col("gone").alias("__llm_gone"), links.alias("__llm_links"))
    found = settle(found.filter((F.size("__llm_gone") > 0) | (F.col("__llm_links") > 0)))
    size = found.agg(F.sum(F.size("__llm_gone") * 4 + 48)).first()[0] or 0
    return F.broadcast(found) if size <= BROADCAST_BYTES else found


def _joined(docs: DataFrame, losses: DataFrame, keys: list) -> DataFrame:
    found = docs.select("*", *keys).join(losses, (F.col(K1) == F.col("__llm_r1")) & (F.col(K2) == F.col("__llm_r2")), "left")
    return found.drop(K1, K2, "__llm_r1", "__llm_r2")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, min_words: int = 5, candidates: int | None = None,
    close: float | None = None,
) -> DataFrame:
    """Per document: doc_id, n_lines (with a word), n_removed, removed (their numbers from 0, counting all lines), kept_sha256.

    Lines end at \\n and are removed with one line end. Documents without an id come last in the order; equal ids are ordered by a hash of
    the text. NULL and empty texts have no lines. Lines of fewer than ``min_words`` words stay. Rows equal in id and text keep the same lines.
    All candidates are verified; ``candidates`` and ``close``, which once limited them, change nothing.
    """
    losses = _lost(*judged_classes(docs, id_col, text_col, threshold, min_words))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    joined = _joined(rows, losses, row_key("doc_id", "text")).drop("__llm_links")
    return joined.mapInArrow(_apply("text", _digest), "doc_id long, n_lines long, n_removed long, removed array<int>, kept_sha256 string")


def linked_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, min_words: int = 5) -> DataFrame:
    """The columns of ``dedup_lines``, by the whole join, and n_links: for each line of the document that takes part, the number of classes of
    other lines that its class is similar to, summed."""
    lines, judged = judged_classes(docs, id_col, text_col, threshold, min_words)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    joined = _joined(rows, _lost(lines, judged), row_key("doc_id", "text"))
    joined = joined.withColumn("n_links", F.coalesce("__llm_links", F.lit(0))).drop("__llm_links")
    schema = "doc_id long, n_lines long, n_removed long, removed array<int>, kept_sha256 string, n_links long"
    return joined.mapInArrow(_apply("text", _digest), schema)


def remove_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, min_words: int = 5, candidates: int | None = None,
    close: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` with all their columns, the text without lines that match an earlier one. A document all of whose lines go is
    left out; one without lines stays. ``candidates`` and ``close`` change nothing (see ``dedup_lines``)."""
    losses = _lost(*judged_classes(docs, id_col, text_col, threshold, min_words))
    joined = _joined(docs, losses, row_key(id_col, text_col)).drop("__llm_links")
    return joined.mapInArrow(_apply(text_col, _replace(text_col)), docs.schema)
