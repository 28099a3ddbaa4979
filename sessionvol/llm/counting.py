"""Sums of long vectors over all tasks: each task keeps one array and sends its non-zero slices once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sessionvol.llm import kernels as K

#: Numbers in a slice.
SLICE = 1 << 14
_CODEC = pa.Codec("zstd", 1)
SENT = "name int, slice int, at binary, n binary"


def _packed(values: np.ndarray) -> bytes:
    return values.nbytes.to_bytes(8, "little") + _CODEC.compress(values.tobytes(), asbytes=True)


def send(arrays: dict[int, np.ndarray]):
    """The rows of SENT for the named arrays of a task."""
    out = []
    for name, counts in arrays.items():
        for k in range(0, len(counts), SLICE):
            at = np.flatnonzero(counts[k : k + SLICE])
            if len(at):
                n = counts[k + at]
                out.append((name, k // SLICE, _packed(at.astype(np.uint16)), _packed(n.astype(np.int32 if n.max() < 1 << 31 else np.int64))))
    if out:
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["name", "slice", "at", "n"])


@K.lean
def _add(batches):
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for name, part, at, n in zip(*(batch.column(c).to_pylist() for c in ("name", "slice", "at", "n"))):
            at = np.frombuffer(_CODEC.decompress(at[8:], int.from_bytes(at[:8], "little"), asbytes=True), np.uint16)
            size = int.from_bytes(n[:8], "little")
            n = np.frombuffer(_CODEC.decompress(n[8:], size, asbytes=True), np.int32 if size == 4 * len(at) else np.int64)
            sums.setdefault((name, part), np.zeros(SLICE, np.int64))[at] += n
    yield from (
        pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int32()), pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["name", "slice", "n"]
        )
        for (name, part), total in sums.items()
    )


def total(sent: DataFrame, lengths: dict[int, int]) -> dict[int, np.ndarray]:
    """The sums, on the driver: as many numbers as ``lengths`` says, whatever the input."""
    rows = sent.repartition("name", "slice").mapInArrow(_add, "name int, slice int, n binary").collect()
    out = {name: np.zeros(-(-n // SLICE) * SLICE, np.int64) for name, n in lengths.items()}
    for name, part, n in rows:
        out[name][part * SLICE : (part + 1) * SLICE] = np.frombuffer(n, np.int64)
    return {name: out[name][:n] for name, n in lengths.items()}
