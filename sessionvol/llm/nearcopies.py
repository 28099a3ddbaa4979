"""Near-duplicate documents by Order MinHash (operator 10).

A text's k-mers are runs of ``k`` words, each labelled with how many times it occurred before (a text of fewer words is one k-mer). For each of
``sketches`` random orders the ``sampled`` smallest labelled k-mers are taken and put back in text order; their hash is one key. Equal keys are likely
for texts of small edit distance, since both the k-mers and their order must agree.

Texts with the same words are one class, and its smallest document (by id, then a hash of the text) stands for it. Every two classes that share
a key and whose lengths allow it are verified on their words, once, under the first key they share: edit similarity, 1 - distance / longer
length, of at least ``threshold``, found by an alignment within the band of diagonals that this allows. Verified links make connected
components; a component's smallest document is its class id.

In a crowded key not every pair needs an alignment of its own. Edit distance obeys the triangle inequality, so the distances of all classes to one of them (a pivot) decide
most pairs: at most their sum, at least their difference. A pivot is a class in the middle of the others, and its distances are kept for all pairs of the tile.
The other pairs are aligned, many of like lengths at a time, so every link is found and counted.

At scale: small entries (key, class) meet in buckets, where copies collapse, and only classes that share a key go on, of keys with the same classes only the first.
They meet by key, large keys dealt to blocks of bounded size, and every two blocks in one task (a tile): first with their numbers of words and the keys before
this one, which tell the classes that have a pair to be verified there. Only these meet again with their words, in the same tile, which hands on,
for each class, its number of links and one link to its part of the tile's graph: rows by class, not by pair. Links and components stay distributed. Words are
compared by 40 bits of a hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import kernels as K
from sessionvol.llm.components import components
from sessionvol.llm.rows import K1, K2, keyed, row_key, ship, shuffle_partitions
from sessionvol.plans.joins import lookup_join
from sessionvol.session import settle

#: Classes with a candidate whose keys are sent to all tasks rather than joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Classes and words of a block of a key.
LIGHT, BLOCK_CLASSES, BLOCK_WORDS = 16, 16384, 1 << 22
#: Bytes of entries in a bucket.
BUCKET_BYTES = 16 << 20
#: Pairs from which on pivots are tried, and pairs that a task compares at a time.
PIVOT, PAIRS = 64, 1 << 21
#: Most pivots of a tile; classes of which one becomes a pivot, and those that it is held against.
PIVOTS, MIDDLE, AROUND = 16, 64, 256
#: Pairs that are aligned at a time, the fewest for which this pays, and the longest texts that it pays for.
ALIGNED, FEWEST, LONGEST = 256, 16, 1024
#: Words of a text whose alignment runs on whole numbers; longer ones go by furthest reaching points.
SHORT = 8192
#: Counters of words of a class; those of two classes bound their edits from below.
CELLS = 64


def sketch(h: np.ndarray, doc: np.ndarray, first: np.ndarray, k: int, sketches: int, sampled: int):
    """Order-min-hash keys of a group of texts with words: (rows, sketches)."""
    # k-mers, each labelled with its occurrence; a short text has one k-mer of all its words.
    size = np.diff(first)
    n = np.where(size >= k, size - k + 1, np.minimum(size, 1))
    row = np.repeat(np.arange(len(size)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]
    grams = K.runs_hash(np.append(h, np.zeros(k, np.uint64)), k)[at]
    short = np.flatnonzero((size < k) & (size > 0))
    begin = np.cumsum(n) - n
    for r in short.tolist():
        grams[begin[r]] = K.mix(np.array([hash(tuple(h[first[r] : first[r + 1]].tolist())) & (2**64 - 1)], np.uint64))[0]
    salted = grams ^ K.mix(row.astype(np.uint64) + np.uint64(1))
    order = np.sort(salted)
    label = np.zeros(len(grams), np.uint64)
    if (order[1:] == order[:-1]).any():
        by = np.argsort(salted, kind="stable")
        s = salted[by]
        new = np.append(True, s[1:] != s[:-1])
        start = np.flatnonzero(new)
        count = np.arange(len(s)) - np.repeat(start, np.diff(np.append(start, len(s))))
        label[by] = count.astype(np.uint64)
    # Labelled whether or not a text repeats a k-mer: a text's keys depend on the text alone.
    grams = K.mix(grams + label * np.uint64(0xD6E8FEB86659FD93))
    out = np.zeros((len(size), sketches), np.uint64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    count, top = n[some], np.uint64(2**64 - 1)
    of = np.repeat(np.arange(len(some)), count)
    # The smallest values of a long text are looked for below a bound that few of its values are below.
    few = np.repeat(np.where(count > 64, top // count.astype(np.uint64) * np.uint64(24), top), count)
    for j in range(sketches):
        mult = np.uint64(int(K.mix(np.array([j + 1], np.uint64))[0]) | 1)
        v = grams * mult
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        at = np.flatnonzero(v <= few)
        held = np.bincount(of[at], minlength=len(some))
        if (held < np.minimum(count, sampled)).any():
            at, held = np.arange(len(v)), count
        v, row = v[at], of[at]
        starts = np.cumsum(held) - held
        places, values = [], []
        for _ in range(sampled):
            low = np.minimum.reduceat(v, starts)
            hit = np.flatnonzero(v == low[row])
            first_hit = hit[np.append(True, row[hit][1:] != row[hit][:-1])]
            places.append(first_hit)
            values.append(np.where(low == top, np.uint64(0), low))
            v[first_hit] = top
        order = np.argsort(np.stack(places), axis=0, kind="stable")
        chosen = np.take_along_axis(np.stack(values), order, axis=0)
        key = np.full(len(some), j + 1, np.uint64)
        for x in chosen:
            key = K.mix(key * np.uint64(0x9E3779B97F4A7C15) + x)
        out[some, j] = key
    return out


def _word_groups(column):
    data, offsets = K.buffer(column)
    for a, b in K.chunks(offsets):
        words = K.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], K.GRAPHIC)
        yield a, b, words, words.hashes()


def _digests(words, h) -> list[np.ndarray]:
    """Two hashes of the sequence of words of each text; 0 without words."""
    place = np.arange(len(h), dtype=np.uint64) - words.first[words.doc].astype(np.uint64)
    some = np.flatnonzero(np.diff(words.first))
    out = [np.zeros(len(words.first) - 1, np.uint64) for _ in range(2)]
    for d, salt in zip(out, (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47)):
        if len(some):
            d[some] = K.mix(np.add.reduceat(K.mix(h ^ K.mix(place + np.uint64(salt))), words.first[:-1][some]))
    return out


@K.lean
def _named(batches):
    """Texts to their number of words and the digests that name their class."""
    for batch in batches:
        keys = [batch.column(c) for c in (K1, K2, "doc_id")]
        for a, b, words, h in _word_groups(batch.column("text")):
            d1, d2 = (pa.array(d.view(np.int64)) for d in _digests(words, h))
            yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in keys), pa.array(np.diff(words.first)), d1, d2], names=[K1, K2, "doc_id", "n_words", "d1", "d2"])


#: Fields of an entry: key, class, words, number of the key.
_ENTRY = {"key": "<u8", "d1": "<i8", "d2": "<i8", "n": "<u4", "j": "<u1"}


def _deal(k: int, sketches: int, sampled: int, buckets: int):
    """Texts to packed entries of their keys, one row per (group of texts, bucket); a class once in a group."""

    def run(batches):
        codec = pa.Codec("zstd", 1)
        held: list[list[np.ndarray]] = []

        def sent():
            got, d1, d2, n = map(np.concatenate, zip(*held))
            held.clear()
            entry = {
                "key": got.reshape(-1), "d1": np.repeat(d1, sketches), "d2": np.repeat(d2, sketches), "n": np.repeat(n, sketches),
                "j": np.tile(np.arange(sketches, dtype=np.uint8), len(n)),
            }
            bucket = (K.mix(entry["key"]) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
            rows = [(b, int(edges[b + 1] - edges[b]), by[edges[b] : edges[b + 1]]) for b in np.flatnonzero(np.diff(edges)).tolist()]
            blobs = [codec.compress(b"".join(np.ascontiguousarray(entry[f][at].astype(t)).tobytes() for f, t in _ENTRY.items()), asbytes=True) for _, _, at in rows]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array(blobs, pa.binary())], names=["bucket", "n", "blob"])

        for batch in batches:
            for _, _, words, h in _word_groups(batch.column("text")):
                d1, d2 = _digests(words, h)
                n = np.diff(words.first)
                some = np.flatnonzero(n)
                if not len(some):
                    continue
                got = sketch(h, words.doc, words.first, k, sketches, sampled)
                one = some[np.unique(np.stack([d1[some], d2[some]]), axis=1, return_index=True)[1]]
                held.append([got[one], d1[one].view(np.int64), d2[one].view(np.int64), n[one].astype(np.uint32)])
                if sum(len(x[0]) for x in held) * sketches > 1 << 19:
                    yield sent()
        if held:
            yield sent()

    return K.lean(run)


_LIVE = "key long, d1 long, d2 long, j int, m long, w long, print1 long, print2 long, lead boolean"


@K.lean
def _shared(batches):
    """Buckets to the classes that share a key with another one, and of each key: classes, words, two fingerprints of its classes."""
    bucket, blobs = None, []
    codec = pa.Codec("zstd")
    size = sum(np.dtype(t).itemsize for t in _ENTRY.values())

    def done():
        parts = []
        for n, blob in blobs:
            raw, at, part = codec.decompress(blob, n * size, asbytes=True), 0, {}
            for f, t in _ENTRY.items():
                part[f] = np.frombuffer(raw, t, n, at)
                at += n * np.dtype(t).itemsize
            parts.append(part)
        e = {f: np.concatenate([p[f] for p in parts]) for f in _ENTRY}
        by = np.lexsort((e["d2"], e["d1"], e["key"]))
        e = {f: v[by] for f, v in e.items()}
        same_key = e["key"][1:] == e["key"][:-1]
        use = np.append(True, ~(same_key & (e["d1"][1:] == e["d1"][:-1]) & (e["d2"][1:] == e["d2"][:-1])))
        e = {f: v[use] for f, v in e.items()}
        begins = np.flatnonzero(np.append(True, e["key"][1:] != e["key"][:-1]))
        length = np.diff(np.append(begins, len(e["key"])))
        use = np.repeat(length > 1, length)
        if not use.any():
            return
        e = {f: v[use] for f, v in e.items()}
        length = length[length > 1]
        begins = np.cumsum(length) - length
        mixed = K.mix(e["d1"].view(np.uint64) ^ K.mix(e["d2"].view(np.uint64)))
        prints = [np.add.reduceat(K.mix(mixed ^ np.uint64(salt)), begins).view(np.int64) for salt in (0x9FB21C651E98DF25, 0xD8F2A1B3C4E5F607)]
        of_key = [length, np.add.reduceat(e["n"].astype(np.int64), begins), *prints]
        lead = np.zeros(len(use[use]), bool)
        lead[begins] = True
        columns = [e["key"].view(np.int64), e["d1"], e["d2"], e["j"].astype(np.int32), *(np.repeat(v, length) for v in of_key), lead]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split(" ")[0] for c in _LIVE.split(", ")])

    for batch in batches:
        for b, n, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n", "blob"))):
            if b != bucket:
                if blobs:
                    yield from done()
                bucket, blobs = b, []
            blobs.append((n, blob))
    if blobs:
        yield from done()


_HELD = f"d1 long, d2 long, unknown boolean, doc_id long, {K2} long, {K1} long, n long, words binary, keys binary"


def _words_and_keys(k: int, sketches: int, sampled: int):
    """First texts of classes to the class, its first document, number of words, words (five bytes each) and 32 bits of each of the keys."""

    def run(batches):
        for batch in batches:
            for a, b, words, h in _word_groups(batch.column("text")):
                raw = np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()
                edges = (words.first * 5).tolist()
                keys = sketch(h, words.doc, words.first, k, sketches, sampled).astype(np.uint32)
                doc_id, k1, k2 = (batch.column(c).slice(a, b - a) for c in ("doc_id", K1, K2))
                columns = [*(pa.array(d.view(np.int64)) for d in _digests(words, h)), doc_id.is_null(), doc_id, k2, k1, pa.array(np.diff(words.first))]
                columns += [pa.array([raw[x:y] for x, y in zip(edges, edges[1:])], pa.binary()), pa.array([r.tobytes() for r in keys], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=_names(_HELD))

    return K.lean(run)


def allowed(n, m, threshold: float):
    """Edits that texts of n and m words may differ in."""
    return ((1 - threshold) * np.maximum(n, m) + 1e-9).astype(np.int64)


class Pattern:
    """A text to be aligned with others, as one whole number for each of its words: the places where it stands."""

    def __init__(self, x: np.ndarray):
        self.n, self.at = len(x), {}
        for i, word in enumerate(x.tolist()):
            self.at[word] = self.at.get(word, 0) | 1 << i

    def edits(self, y: np.ndarray, most: int) -> int:
        """The edit distance to ``y`` if it is at most ``most``, else more than that.

        Column by column over the rows of a band of ``most`` diagonals to either side, a bit for each row's difference to the one above (G. Myers, 1999); outside the band
        the largest possible differences are taken, which no path of so few edits can use.
        """
        m, n = self.n, len(y)
        if abs(m - n) > most:
            return most + 1
        if not m:
            return n
        low, high = 0, min(m, most)
        score, up, down = high, (1 << high) - 1, 0
        for column, word in enumerate(y.tolist(), 1):
            if high < m:
                up |= 1 << (high - low)
                score += 1
                high += 1
            mask = (1 << (high - low)) - 1
            equal = (self.at.get(word, 0) >> low) & mask
            zero = ((((equal & up) + up) ^ up) | equal | down) & mask
            right_up, right_down = (down | ~(zero | up)) & mask, up & zero
            last = high - low - 1
            score += (right_up >> last) - (right_down >> last)
            right_up, right_down = (right_up << 1 | 1) & mask, (right_down << 1) & mask
            up, down = (right_down | ~(zero | right_up)) & mask, right_up & zero
            if column > most:
                low += 1
                up >>= 1
                down >>= 1
        return score if high == m else most + 1


def similar(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    """Is the edit similarity of two sequences at least ``threshold``?

    Equal beginnings and ends aside, an alignment in the band that so many edits can reach.
    """
    longer = max(len(x), len(y))
    most = int((1 - threshold) * longer + 1e-9)  # edits allowed
    if abs(len(x) - len(y)) > most:
        return False
    if len(x) == len(y) and np.count_nonzero(x != y) <= most:
        return True
    # Sequences that share too few items are no candidates for an alignment.
    items, n = np.unique(np.concatenate([np.unique(x), np.unique(y)]), return_counts=True)
    shared = items[n > 1]
    if longer - min(np.isin(x, shared).sum(), np.isin(y, shared).sum()) > most:
        return False
    head = min(len(x), len(y))
    differ = np.flatnonzero(x[:head] != y[:head])
    head = int(differ[0]) if len(differ) else head
    x, y = x[head:], y[head:]
    tail = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - tail :][::-1] != y[len(y) - tail :][::-1])
    tail = int(differ[0]) if len(differ) else tail
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    if not len(x) or not len(y):
        return max(len(x), len(y)) <= most
    return Pattern(x).edits(y, most) <= most if min(len(x), len(y)) <= SHORT else _banded(x, y, most)


def _banded(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """Furthest reaching points by number of edits, on the diagonals of the band only: for long texts."""
    n, m = len(x), len(y)
    goal = m - n
    reach = np.full(2 * most + 3, -1, np.int64)  # by diagonal j - i, from -most - 1 on: furthest i
    mid = most + 1

    def slide(lo: int, hi: int, i: np.ndarray) -> np.ndarray:
        """Follow equal items from rows i of diagonals lo..hi, eight more at a time."""
        diagonal = np.arange(lo, hi + 1)
        live = np.arange(len(i))
        width = 8
        while len(live):
            cols = i[live][:, None] + np.arange(width)
            other = cols + diagonal[live][:, None]
            inside = (cols < n) & (other < m) & (other >= 0)
            same = inside & (x[np.minimum(cols, n - 1)] == y[np.clip(other, 0, m - 1)])
            run = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
            i[live] += run
            live = live[run == width]
            width = min(256, width * 2)
        return i

    reach[mid] = slide(0, 0, np.zeros(1, np.int64))[0]
    if reach[mid] >= n and goal == 0:
        return True
    for edits in range(1, most + 1):
        lo, hi = -edits, edits
        # A diagonal that cannot come back to the goal within the edits left is out of the band.
        left = most - edits
        lo, hi = max(lo, goal - left), min(hi, goal + left)
        if lo > hi:
            return False
        d = np.arange(lo, hi + 1) + mid
        best = np.maximum(np.maximum(reach[d] + 1, reach[d - 1]), reach[d + 1] + 1)
        fresh = np.minimum(best, np.minimum(n, m - np.arange(lo, hi + 1)))
        ok = best >= 0
        fresh = np.where(ok, np.maximum(fresh, 0), 0)
        fresh = slide(lo, hi, fresh)
        new = np.full_like(reach, -1)
        new[d] = np.where(ok, fresh, -1)
        reach = new
        if lo <= goal <= hi and reach[goal + mid] >= n:
            return True
    return False


def edits_of_pairs(codes: np.ndarray, x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The edit distance of each pair of texts if it is at most the pair's ``most``, else one more.

    ``codes`` are the words of all texts as small numbers; the texts of a pair begin at ``x`` and ``y`` there and have ``n`` and ``m`` words. The table of
    distances is filled by antidiagonals, all pairs at a time, within the diagonals that a path of so few edits can reach and come back from.
    """
    goal = m - n
    out = (most + 1).astype(np.int64)
    use = np.flatnonzero(np.abs(goal) <= most)
    if not len(use):
        return out
    x, n, y, m, goal, limit = x[use], n[use], y[use], m[use], goal[use], most[use]
    rows, columns, pairs = int(n.max()), int(m.max()), len(use)
    low, high = int(((limit - goal) // 2).max()), int(((limit + goal) // 2).max())  # diagonals j - i from -low to high
    # Words of a shorter text are followed by any others: they stand behind the cell that is asked for. Row 0 stands before the first word.
    at = np.arange(-1, max(rows, columns))[:, None]
    left = codes[np.clip(x + at[: rows + 1], 0, len(codes) - 1)]
    right = codes[np.clip(y + at[: columns + 1], 0, len(codes) - 1)][::-1].copy()
    far = np.iinfo(codes.dtype).max // 2
    before, last, now = (np.full((rows + 3, pairs), far, codes.dtype) for _ in range(3))  # the cell of row i at i + 1
    differ = np.empty((min(rows, (low + high) // 2 + 1) + 2, pairs), codes.dtype)
    last[1] = 0
    ends = n + m
    by = np.argsort(ends, kind="stable")
    upto = np.searchsorted(ends[by], np.arange(int(ends.max()) + 1), "right").tolist()  # pairs whose last cell is in an antidiagonal or before it
    done = upto[0]
    found = np.zeros(pairs, np.int64)  # two empty texts
    for s in range(1, int(ends.max()) + 1):
        top, bottom = max(0, s - columns, -((high - s) // 2)), min(rows, s, (s + low) // 2)
        if top <= bottom:
            d, cell = differ[: bottom + 1 - top], now[top + 1 : bottom + 2]
            np.bitwise_xor(left[top : bottom + 1], right[columns - s + top : columns - s + bottom + 1], out=d)
            np.minimum(d, 1, out=d)
            d += before[top : bottom + 1]
            np.minimum(last[top : bottom + 1], last[top + 1 : bottom + 2], out=cell)
            cell += 1
            np.minimum(cell, d, out=cell)
        now[top] = now[bottom + 2] = far
        if upto[s] > done:
            hit = by[done : upto[s]]
            found[hit], done = now[n[hit] + 1, hit], upto[s]
        before, last, now = last, now, before
    out[use] = np.minimum(found, out[use])
    return out


class Meeting:
    """Classes of one key, or of two of its blocks: their numbers of words, the keys before this one, and which have a pair to be verified here."""

    def __init__(self, n: np.ndarray, keys: np.ndarray, threshold: float):
        self.n, self.keys, self.threshold = n, keys, threshold
        self.paired = np.zeros(len(n), bool)

    def compare(self, x: np.ndarray, y: np.ndarray, same: bool, depth: int = 6) -> None:
        """Take the pairs of rows x by y, or those within x, that share no key before this one."""
        rows = x if same else np.concatenate([x, y])
        if depth and len(rows) >= 64 and self.keys.shape[1]:
            value, n, column = 0, 0, 0
            for c in range(self.keys.shape[1]):  # the most common earlier key: pairs that both have it met there
                v, counts = np.unique(self.keys[rows, c], return_counts=True)
                if counts.max() > n:
                    value, n, column = v[np.argmax(counts)], counts.max(), c
            if 3 * n >= len(rows):
                has = self.keys[:, column] == value
                rest = x[~has[x]]
                if same:
                    self.compare(rest, rest, True, depth - 1)
                    self.compare(rest, x[has[x]], False, depth - 1)
                else:
                    self.compare(rest, y, False, depth - 1)
                    self.compare(x[has[x]], y[~has[y]], False, depth - 1)
                return
        if not len(x) or not len(y):
            return
        step = max(1, PAIRS // len(y))
        for k in range(0, len(x), step):
            self._pairs(x[k : k + step], y, same)

    def _asked(self, x: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair: the edits allowed, and whether it is to be verified."""
        most = allowed(self.n[x][:, None], self.n[y][None, :], self.threshold)
        ask = np.abs(self.n[x][:, None] - self.n[y][None, :]) <= most
        if same:
            ask &= x[:, None] < y[None, :]
        for c in range(self.keys.shape[1]):
            if not ask.any():
                break
            ask &= self.keys[x, c][:, None] != self.keys[y, c][None, :]
        return most, ask

    def _pairs(self, x: np.ndarray, y: np.ndarray, same: bool) -> None:
        if self.paired[x].all() and self.paired[y].all():
            return
        _, ask = self._asked(x, y, same)
        self.paired[x] |= ask.any(axis=1)
        self.paired[y] |= ask.any(axis=0)


class Tile(Meeting):
    """Classes that meet, with their words, and what is found of them."""

    def __init__(self, words: list[np.ndarray], keys: np.ndarray, threshold: float):
        super().__init__(np.array([len(w) for w in words]), keys, threshold)
        self.words = words
        self.links, self.part = np.zeros(len(words), np.int64), np.arange(len(words))
        #: Class, the most that is told of its distances, and those to all classes: -1 where not known, -2 where not yet found.
        self.pivots: list[tuple[int, int, np.ndarray]] = []
        self._cells: np.ndarray | None = None
        self._codes: tuple[np.ndarray, np.ndarray] | None = None

    def root(self, r: int) -> int:
        return int(self.part[r])

    def cells(self) -> np.ndarray:
        if self._cells is None:
            flat, row = np.concatenate(self.words), np.repeat(np.arange(len(self.words)), self.n)
            counts = np.bincount(row * CELLS + (flat & np.uint64(CELLS - 1)).astype(np.int64), minlength=len(self.words) * CELLS)
            self._cells = counts.reshape(-1, CELLS).astype(np.int32)
        return self._cells

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """All words as numbers from 0, and where each class's begin."""
        if self._codes is None:
            different, codes = np.unique(np.concatenate(self.words), return_inverse=True)
            self._codes = codes.astype(np.uint16 if len(different) < 1 << 16 else np.uint32), np.cumsum(self.n) - self.n
        return self._codes

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Edits that each pair needs at least, by its counters of words."""
        out, cells = np.zeros(len(x), np.int64), self.cells()
        for k in range(0, len(x), 1 << 16):
            part = slice(k, k + (1 << 16))
            off = cells[x[part]] - cells[y[part]]
            out[part] = np.maximum(np.maximum(off, 0).sum(axis=1), np.maximum(-off, 0).sum(axis=1))
        return out

    def _aligned(self, x: np.ndarray, y: np.ndarray, most: np.ndarray):
        """Groups of pairs of like lengths, with the edits of each if at most ``most``, else one more. Pairs that are too few or too long for that are in no group."""
        longer = np.maximum(self.n[x], self.n[y])
        by = np.flatnonzero(longer <= LONGEST)
        by = by[np.argsort(longer[by], kind="stable")]
        begin = 0
        while len(by) - begin >= FEWEST:
            end = min(begin + ALIGNED, int(np.searchsorted(longer[by], longer[by[begin]] * 5 // 4 + 8, "right")))
            if end - begin >= FEWEST:
                codes, first = self.codes()
                g = by[begin:end]
                yield g, edits_of_pairs(codes, first[x[g]], self.n[x[g]], first[y[g]], self.n[y[g]], most[g])
            begin = end

    def _pivot(self, rows: np.ndarray) -> bool:
        """One more pivot in the middle of some classes; False if there is none."""
        rows = rows[self.n[rows] <= SHORT]
        if not len(rows) or len(self.pivots) == PIVOTS:
            return False
        some, around = (rows[np.unique(np.linspace(0, len(rows) - 1, n).astype(np.int64))] for n in (MIDDLE, AROUND))
        some = np.setdiff1d(some, [p[0] for p in self.pivots])
        if not len(some):
            return False
        off = self.apart(np.repeat(some, len(around)), np.tile(around, len(some))).reshape(len(some), len(around))
        reach = allowed(self.n[some], self.n[some], self.threshold)
        pivot = some[np.argmin(np.minimum(off / np.maximum(reach, 1)[:, None], 1).sum(axis=1))]
        self.pivots.append((int(pivot), 2 * int(allowed(self.n[pivot], self.n[pivot], self.threshold)) + 2, np.full(len(self.n), -2, np.int32)))
        return True

    def _reach(self, k: int, rows: np.ndarray) -> None:
        """The distances of classes to the pivot numbered k, those over its bound as one more."""
        pivot, bound, far = self.pivots[k]
        rows = rows[far[rows] == -2]
        far[rows[self.n[rows] > SHORT]] = -1
        rows = rows[self.n[rows] <= SHORT]
        off = self.apart(np.full(len(rows), pivot), rows) > bound
        far[rows[off]] = bound + 1
        rows = rows[~off]
        for g, edits in self._aligned(np.full(len(rows), pivot), rows, np.full(len(rows), bound)):
            far[rows[g]] = edits
        rows = rows[far[rows] == -2]
        if len(rows):
            pattern = Pattern(self.words[pivot])
            far[rows] = [min(pattern.edits(self.words[r], bound), bound + 1) for r in rows.tolist()]

    def _pairs(self, x: np.ndarray, y: np.ndarray, same: bool) -> None:
        most, ask = self._asked(x, y, same)
        k = 0
        while (n_open := int(ask.sum())) >= PIVOT:
            rows = np.union1d(x[ask.any(axis=1)], y[ask.any(axis=0)])
            fresh = k == len(self.pivots)
            # Distances to a pivot are to cost less than they can save.
            if n_open < 2 * len(rows) or fresh and not self._pivot(rows):
                break
            self._reach(k, rows)
            _, bound, far = self.pivots[k]
            k += 1
            d_x, d_y = far[x], far[y]
            known = (d_x >= 0)[:, None] & (d_y >= 0)[None, :] & ask
            near_x, near_y = (d_x <= bound)[:, None], (d_y <= bound)[None, :]
            link = known & near_x & near_y & (d_x[:, None] + d_y[None, :] <= most)
            # A distance over the bound is at least one more than it.
            apart = np.abs(d_x[:, None] - d_y[None, :]) > most
            apart &= known & (near_x | near_y)
            self._note(x, y, link)
            ask &= ~(link | apart)
            if fresh and n_open - int(ask.sum()) < len(rows):
                break
        at_x, at_y = np.nonzero(ask)
        if not len(at_x):
            return
        most = most[at_x, at_y]
        a, b = x[at_x], y[at_y]
        keep = self.apart(a, b) <= most
        at_x, at_y, a, b, most = (v[keep] for v in (at_x, at_y, a, b, most))
        alike, left = np.zeros(len(a), bool), np.ones(len(a), bool)
        for g, edits in self._aligned(a, b, most):
            alike[g], left[g] = edits <= most[g], False
        for r in np.flatnonzero(left).tolist():
            alike[r] = similar(self.words[a[r]], self.words[b[r]], self.threshold)
        link = np.zeros_like(ask)
        link[at_x, at_y] = alike
        self._note(x, y, link)

    def _note(self, x: np.ndarray, y: np.ndarray, link: np.ndarray) -> None:
        self.links[x] += link.sum(axis=1)
        self.links[y] += link.sum(axis=0)
        # The smallest class of a part stands for it.
        for a in np.flatnonzero(link.any(axis=1)).tolist():
            own, parts = self.part[x[a]], self.part[y[link[a]]]
            if (parts != own).any():
                parts = np.unique(np.append(parts, own))
                self.part[np.isin(self.part, parts)] = parts[0]


_OPEN = "key long, x int, y int, block int, j int, d1 long, d2 long"
_MEETING = f"{_OPEN}, n long, keys binary"
_TILE = f"key long, x int, y int, block int, j int, unknown boolean, doc_id long, {K2} long, {K1} long, words binary, keys binary"


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def _meet(meeting: Meeting, block: np.ndarray, x: int, y: int) -> None:
    """All pairs of a block, or those of two."""
    rows = np.arange(len(block))
    if x == y:
        meeting.compare(rows, rows, True)
    else:
        meeting.compare(rows[block == x], rows[block == y], False)


def _open(threshold: float):
    """Classes by tile to those that have a pair to be verified there."""

    def run(batches):
        for table, edges in K.tiles(batches):
            j, block, xs, ys, n = (table.column(c).to_numpy().astype(np.int64) for c in ("j", "block", "x", "y", "n"))
            raw, key_at = K.buffer(table.column("keys"))
            paired = []
            for lo, hi in zip(edges, edges[1:]):
                meeting = Meeting(n[lo:hi], raw[key_at[lo] : key_at[hi]].view(np.uint32).reshape(hi - lo, j[lo]), threshold)
                _meet(meeting, block[lo:hi], xs[lo], ys[lo])
                paired.append(meeting.paired)
            yield from table.select(_names(_OPEN)).filter(pa.array(np.concatenate(paired))).to_batches()

    return K.lean(run)


def _early() -> Column:
    """The keys before the one numbered j."""
    return F.substring("keys", F.lit(1), 4 * F.col("j"))


def _tiles(threshold: float):
    """Tiles to their classes with a link: (class, one class for each connected part, number of links)."""

    def run(batches):
        for table, edges in K.tiles(batches):
            names = pa.StructArray.from_arrays([table.column(c).combine_chunks() for c in ("unknown", "doc_id", K2, K1)], names=["unknown", "doc_id", K2, K1])
            j, block, xs, ys = (table.column(c).to_numpy().astype(np.int64) for c in ("j", "block", "x", "y"))
            data, offsets = K.buffer(table.column("words"))
            raw, key_at = K.buffer(table.column("keys"))
            for lo, hi in zip(edges, edges[1:]):
                part = data[offsets[lo] : offsets[hi]].reshape(-1, 5)
                wide = np.zeros((len(part), 8), np.uint8)
                wide[:, :5] = part
                flat, at = wide.reshape(-1).view(np.uint64), ((offsets[lo : hi + 1] - offsets[lo]) // 5).tolist()
                tile = Tile([flat[a:b] for a, b in zip(at, at[1:])], raw[key_at[lo] : key_at[hi]].view(np.uint32).reshape(hi - lo, j[lo]), threshold)
                _meet(tile, block[lo:hi], xs[lo], ys[lo])
                some = np.flatnonzero(tile.links)
                if len(some):
                    roots = pa.array([lo + tile.root(r) for r in some.tolist()])
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(lo + some)), names.take(roots), pa.array(tile.links[some])], names=["a", "b", "n"])

    return K.lean(run)


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, sketches: int = 48, sampled: int = 3, threshold: float = 0.8
) -> DataFrame:
    """Per document: row key, doc_id, class_id (doc_id of the class's first document), is_first, n_links (verified links of the document's
    text with other texts).

    Documents are ordered by id, those without one last, equal ids by a hash of the text. NULL and empty texts, and those without a word, are
    classes of their own. Rows equal in id and text have equal result rows. Runs jobs when called.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = keyed(docs, id_col, text_col)
    rows = settle(texts.mapInArrow(_named, f"{K1} long, {K2} long, doc_id long, n_words long, d1 long, d2 long"))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", K2, K1)
    # One class for each sequence of words; texts without words keep their own.
    named = rows.withColumn("d1", F.when(F.col("n_words") == 0, F.col(K1)).otherwise(F.col("d1")))
    named = named.withColumn("d2", F.when(F.col("n_words") == 0, F.col(K2)).otherwise(F.col("d2")))
    firsts = settle(named.groupBy("d1", "d2", (F.col("n_words") == 0).alias("none")).agg(F.min(place).alias("first")))

    entries = firsts.filter("not none").count() * sketches * sum(np.dtype(t).itemsize for t in _ENTRY.values())
    buckets = max(shuffle_partitions(spark), int(entries / BUCKET_BYTES) + 1)
    dealt = texts.select("text").mapInArrow(_deal(k, sketches, sampled, buckets), "bucket long, n long, blob binary")
    live = settle(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared, _LIVE))
    # Of keys with the same classes the first one is enough: all pairs under the others share it, too.
    groups = live.filter("lead").groupBy("m", "print1", "print2").agg(F.min(F.struct("j", "key")).alias("first"))
    live = settle(lookup_join(live.select("key", "d1", "d2", "j", "m", "w"), groups.select(F.col("first.key").alias("key")), ["key"], "inner", spread=("d1", "d2")))

    ends = settle(live.select("d1", "d2").distinct().join(firsts.filter("not none"), ["d1", "d2"]).select(f"first.{K1}", f"first.{K2}"))
    some = F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends
    held = settle(texts.join(some, [K1, K2], "left_semi").mapInArrow(_words_and_keys(k, sketches, sampled), _HELD))
    # Rows equal in id and text have all come: each class once.
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_CLASSES), F.ceil(F.col("w") / BLOCK_WORDS)).cast("int")
    met = live.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("d1", "d2"), "blocks").cast("int"))
    met = met.join(held.select("d1", "d2", "n", "keys").dropDuplicates(["d1", "d2"]), ["d1", "d2"]).withColumn("keys", _early())
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")}).select(*_names(_MEETING))
    dealt = met.repartition(shuffle_partitions(spark), "key", "x", "y").sortWithinPartitions("key", "x", "y")
    paired = settle(dealt.mapInArrow(_open(threshold), _OPEN))
    words = held.drop("n").dropDuplicates(["d1", "d2"])
    tiles = paired.join(words, ["d1", "d2"]).withColumn("keys", _early()).select(*_names(_TILE))
    dealt = tiles.repartition(shuffle_partitions(spark), "key", "x", "y").sortWithinPartitions("key", "x", "y")
    order = f"struct<unknown:boolean,doc_id:bigint,{K2}:bigint,{K1}:bigint>"
    many = settle(dealt.mapInArrow(_tiles(threshold), f"a {order}, b {order}, n long"))

    links = many.select("a", "b").filter("a <> b")
    degree = many.groupBy("a").agg(F.sum("n").alias("n_links"))
    roots = components(links)
    found = (
        firsts.join(roots, F.col("first") == F.col("node"), "left").join(degree, F.col("first") == F.col("a"), "left")
        .select("d1", "d2", "none", F.coalesce("root", "first").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    return named.withColumn("none", F.col("n_words") == 0).join(found, ["d1", "d2", "none"]).select(
        K1, K2, "doc_id", F.col("root.doc_id").alias("class_id"),
        ((F.col(K1) == F.col(f"root.{K1}")) & (F.col(K2) == F.col(f"root.{K2}"))).alias("is_first"), "n_links",
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, sketches: int = 48, sampled: int = 3, threshold: float = 0.8
) -> DataFrame:
    """The rows, with all their columns, of the first document of each class; of rows equal in id and text one stays."""
    found = settle(near_copies(docs, id_col, text_col, k, sketches, sampled, threshold).select(K1, K2, "is_first"))
    gone = found.filter(~F.col("is_first")).select(K1, K2).distinct()
    again = found.filter("is_first").groupBy(K1, K2).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(K1, K2)
    gone, again = settle(gone), settle(again)
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    left = docs.select("*", *row_key(id_col, text_col)).join(gone, [K1, K2], "left_anti")
    single = left.join(again, [K1, K2], "left_anti")
    doubled = left.join(again, [K1, K2], "left_semi").dropDuplicates([K1, K2])
    return single.select(*docs.columns).union(doubled.select(*docs.columns))
