"""Code points of many texts at once, for operators on characters. Used inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Table:
    """A function of code points to code points, evaluated once for each that occurs."""

    def __init__(self, function: Callable[[str], int]):
        self.function, self.values = function, np.full(0x110000, -1, np.int32)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        out = self.values[points]
        if (out < 0).any():
            for p in np.unique(points[out < 0]).tolist():
                self.values[p] = self.function(chr(p))
            out = self.values[points]
        return out


def letter(c: str) -> int:
    """The lower-case letter, or 0."""
    return ord(c.lower()[0]) if c.isalpha() else 0


def folded(c: str) -> int:
    """Lower case, white space as a space."""
    return 32 if c.isspace() else ord(c.lower()[0])


def points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts and the offsets of each; broken bytes become U+FFFD."""
    raw = data.tobytes()
    try:
        joined = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        count = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=count[1:])
        return joined, count[offsets]
    except UnicodeDecodeError:
        parts = [
            np.frombuffer(raw[a:b].decode(errors="replace").encode("utf-32-le"), np.uint32)
            for a, b in zip(offsets.tolist(), offsets[1:].tolist())
        ]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
