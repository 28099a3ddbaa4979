"""Words of many texts at once, as numpy arrays over one byte buffer.

Used inside Spark tasks on Arrow batches. Nothing here depends on Spark. Texts are cut into groups of
about CHUNK bytes first, so that the temporary arrays of a task have a fixed size; one text alone may
be longer than that.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20


def release() -> None:
    """Give free memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable) -> Callable:
    """A function of a task's batches that gives memory back at its end: Python workers live on, and wait, beside other ones."""

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans that is false in the given closed ranges."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


#: Bytes of words ``[^\x20\x09-\x0D]+`` in UTF-8.
GRAPHIC = byte_class((0x09, 0x0D), (0x20, 0x20))
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, in order, at least one row each."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, n, low + limit // 16)
        yield low, high
        low = high


class Words:
    """The words of a group of texts: ``starts`` and ``ends`` in ``data``, ``doc`` (row), ``first``
    (n + 1 positions: where each row's words begin)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.data, self.n_docs = data, len(offsets) - 1
        self.inside = inside = is_word[data] if len(data) else np.zeros(0, bool)
        edge = np.zeros(len(data) + 1, bool)  # a text begins here
        edge[offsets] = True
        before = np.empty_like(inside)
        if len(data):
            before[0] = False
            before[1:] = inside[:-1]
            before &= ~edge[:-1]
        self.starts = np.flatnonzero(inside & ~before)
        if len(data):
            before[-1] = False
            before[:-1] = inside[1:]
            before &= ~edge[1:]
        self.ends = np.flatnonzero(inside & ~before) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        where = np.flatnonzero(self.inside)
        place = where - np.repeat(self.starts, lengths)
        powers = np.ones(int(lengths.max()), np.uint64)
        powers[1:] = _STEP
        value = _BYTE[self.data[where]] * np.multiply.accumulate(powers)[place]
        begins = np.zeros(len(lengths), np.int64)
        np.cumsum(lengths[:-1], out=begins[1:])
        return mix(np.add.reduceat(value, begins))

    def tidy(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words of each text with one space after each: bytes, starts and ends of the words."""
        lengths = self.ends - self.starts
        starts = np.zeros(len(lengths), np.int64)
        np.cumsum(lengths[:-1] + 1, out=starts[1:])
        out = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
        target = np.ones(len(out), bool)
        target[starts + lengths] = False
        out[target] = self.data[self.inside]
        return out, starts, starts + lengths


def runs_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive items, also across texts; len(h) - k + 1 of them."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, have, power, span = None, 0, h, 1
    # Runs of 1, 2, 4, ... items, and of the sum of those in k's binary form so far.
    while True:
        if k & span:
            if out is None:
                out, have = power, span
            else:
                n = len(h) - have - span + 1
                out = out[:n] + power[have : have + n] * np.uint64(pow(int(_STEP), have, 1 << 64))
                have += span
        if have == k:
            break
        n = len(power) - span
        power = power[:n] + power[span:] * np.uint64(pow(int(_STEP), span, 1 << 64))
        span *= 2
    return mix(out[: len(h) - k + 1].copy())


def runs_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each ``w`` consecutive values."""
    if len(x) < w:
        return x[:0]
    span, low = 1, x
    while span * 2 <= w:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    n = len(x) - w + 1
    return np.minimum(low[:n], low[w - span : w - span + n])


def within(doc: np.ndarray, k: int) -> np.ndarray:
    """For each run of ``k`` words: does it lie in one text?"""
    return doc[: len(doc) - k + 1] == doc[k - 1 :] if len(doc) >= k else np.zeros(0, bool)


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Booleans for n words: is the word in a run of ``k`` words that starts at one of ``starts``?"""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + k, -1)
    return np.cumsum(change[:-1]) > 0


def tiles(batches):
    """Tables of whole tiles (equal key, x, y, in order), and where each tile begins and ends in them."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        tile = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "x", "y")])
        edges = [0, *(np.flatnonzero((tile[:, 1:] != tile[:, :-1]).any(axis=0)) + 1).tolist()]
        if len(edges) > 1:
            yield table.slice(0, edges[-1]).combine_chunks(), edges
        rest = table.slice(edges[-1])
    if rest is not None:
        yield rest.combine_chunks(), [0, len(rest)]
