"""Best-fit packing of documents into sequences of a fixed number of tokens (operator 2).

Vector best-fit: an open sequence has three residual capacities: tokens, documents, and attention cost
(the sum of squared piece lengths). A piece may go where it fits under all three. Among those sequences the one with
the smallest weighted norm of what would be left is chosen, or with ``rule="dot"`` the one whose residual has the
largest weighted dot product with the piece. Pieces are taken longest first.

A text's ids end with one separator id. Only what is longer than a sequence is cut, from its end into full pieces, so that the
first piece may be shorter.

At scale: texts are tokenised where they are read and only places, lengths and checksums of pieces
are shuffled, in blocks of about BLOCK pieces. A block is packed by one task with arrays of that size; many equal rows in one block
are packed in several rounds of at most 2 * BLOCK. Each block leaves at most a few sequences partly empty.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import kernels as K
from sessionvol.llm.rows import keyed, ship
from sessionvol.llm.tokens import default_path, encoder

#: Pieces packed together.
BLOCK = 8192
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_IDS = ", ids binary"


def _cut(path: str, capacity: int, separator: int, with_ids: bool):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            texts, ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for i in range(len(batch)):
                tokens = np.array(enc.ids(texts[i].as_py()), "<u4")
                tokens = np.append(tokens, np.uint32(separator)).astype("<u4")
                first = len(tokens) % capacity or capacity
                edges = [0, *range(first, len(tokens) + 1, capacity)]
                for k in range(len(edges) - 1):
                    part = tokens[edges[k] : edges[k + 1]].tobytes()
                    rows.append((ids[i], k, edges[k], edges[k + 1] - edges[k], zlib.crc32(part), part))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + with_ids]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return K.lean(run)


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, separator: int = 0,
    tokenizer: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all texts: doc_id, piece, start, length, ids_crc32, and with ``with_ids`` the ids as
    little-endian 32-bit numbers. A NULL or empty text is one piece of the separator alone."""
    ship(docs.sparkSession)
    texts = keyed(docs, id_col, text_col).select("doc_id", "text")
    return texts.mapInArrow(_cut(tokenizer or default_path(), capacity, separator, with_ids), _PIECE + _IDS * with_ids)


def best_fit(
    lengths: np.ndarray, capacity: int, max_docs: int, max_attention: int, weights: tuple[float, float, float], rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = np.array([capacity, max_docs, max_attention], float)
    scale = np.sqrt(np.array(weights, float))[:, None] / full[:, None]
    left = np.zeros((3, 1024))  # residuals of the bins that can still take the shortest piece
    name = np.zeros(1024, np.int64)
    used, count = 0, 0
    least = int(lengths.min(initial=capacity))
    need_least = np.array([least, 1, least * least], float)
    for i in order.tolist():
        n = int(lengths[i])
        need = np.array([n, 1, n * n], float)
        here = left[:, :used]
        fits = np.flatnonzero((here >= need[:, None]).all(axis=0)) if used else ()
        if len(fits):
            after = here[:, fits]
            if rule == "norm":
                after = (after - need[:, None]) * scale
                j = fits[np.argmin((after * after).sum(axis=0))]
            else:
                j = fits[np.argmax(((after * scale) * (need[:, None] * scale)).sum(axis=0))]
        else:
            if n > capacity or n * n > max_attention or max_docs < 1:
                raise ValueError(f"a piece of {n} tokens fits in no sequence")
            if used == left.shape[1]:
                left, name = np.concatenate([left, np.zeros_like(left)], axis=1), np.concatenate([name, name])
            j, used = used, used + 1
            left[:, j], name[j], count = full, count, count + 1
        bins[i], offsets[i] = name[j], capacity - left[0, j]
        left[:, j] -= need
        if (left[:, j] < need_least).any():  # closed: the last one takes its place
            used -= 1
            left[:, j], name[j] = left[:, used], name[used]
    return bins, offsets


def _pack(capacity: int, max_docs: int, max_attention: int, weights: tuple[float, float, float], rule: str, size: int):
    def run(batches):
        held: list[pa.RecordBatch] = []
        block, base = None, 0

        def done():
            nonlocal base
            table = pa.Table.from_batches(held)
            bins, offsets = best_fit(table["length"].to_numpy(), capacity, max_docs, max_attention, weights, rule)
            table = table.append_column("sequence_id", pa.array(bins + base + (block << 32)))
            table = table.append_column("offset", pa.array(offsets)).drop_columns(["__block"])
            base += int(bins.max()) + 1
            held.clear()
            return table.combine_chunks().to_batches()

        for batch in batches:
            of = batch.column("__block").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of)) if len(of) else ()
            for a, b in zip(edges, edges[1:]):
                for c in range(a, b, size):
                    if of[c] != block or sum(map(len, held)) >= size:
                        if held:
                            yield from done()
                        if of[c] != block:
                            block, base = int(of[c]), 0
                    held.append(batch.slice(c, min(size, b - c)))
        if held:
            yield from done()

    return K.lean(run)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, separator: int = 0,
    max_docs: int | None = None, max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 1 / 64, 1 / 64),
    rule: str = "norm", tokenizer: str | None = None, with_ids: bool = False, block_pieces: int = BLOCK,
) -> DataFrame:
    """All pieces with their place: doc_id, piece, start, length, ids_crc32 (, ids), sequence_id, offset.

    Sequence numbers are unique but not dense; offsets in a sequence begin at 0 and have no gaps. Without
    ``max_docs`` and ``max_attention`` only tokens limit a sequence: a sequence has ``capacity`` documents
    and the square of it as attention cost at most anyway. ``weights`` are those of tokens, documents and attention in norm and dot product.
    Equal rows are packed as rows of their own. Runs one job when called: the number of rows.
    """
    spark = docs.sparkSession
    blocks = docs.count() // block_pieces + 1
    rows = pieces(docs, id_col, text_col, capacity, separator, tokenizer, with_ids)
    block = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(blocks)).cast("int")
    dealt = rows.withColumn("__block", block).repartition("__block").sortWithinPartitions("__block")
    limits = (capacity, capacity if max_docs is None else max_docs, capacity**2 if max_attention is None else max_attention)
    schema = _PIECE + _IDS * with_ids + ", sequence_id long, offset long"
    return dealt.mapInArrow(_pack(*limits, weights, rule, block_pieces), schema)
