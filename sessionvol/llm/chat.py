"""Chat formatting in budgeted windows (operator 5).

A conversation becomes one or more training strings of at most ``budget`` tokens. Prefix sums of the turns' tokens choose the spans:
a window takes as many whole turns as fit beside the system turn, which every window repeats, and beside limited history: the
last turns before it, at most ``history`` tokens of them. Repeated turns are context only; under the loss mask is each
assistant text once, in the window that first has it. A turn beside which the system turn doesn't fit has a window without it, so a window is over the budget only if
it is one turn that is so alone.

The template: ``<s>[TURN role]text[/TURN]`` for each turn, ``</s>`` at the end; tokens are counted on its strings, marks and escapes included. Strings that look like its marks in
roles and texts get a backslash behind their first character, and one more if they have some there, so that reading back is exact.

At scale: turns are dealt by conversation, sorted, and read as a stream. A task holds the turns of the open window and the
history, never a conversation; one conversation is one task's stream.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import kernels as K
from sessionvol.llm.rows import ship

_MARK = r"(?=(?:/?s>|/?INST\]|/?TURN[ \]]|/?SYS>))"
_ESCAPE = re.compile(r"([<\[])(\\*)" + _MARK)
_UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _MARK)
_TURN = re.compile(r"\[TURN ((?:[^\]\\]|\\.)*)\](.*?)\[/TURN\]", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    return re.sub(r"([\\\]])", r"\\\1", escape(role))


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", r"\1", role, flags=re.S))


def words_and_marks(text: str) -> int:
    """The default unit of budgets."""
    return len(re.findall(r"\w+|[^\w\s]", text))


def n_tokens(text: str) -> int:
    """Words and marks of a turn's text and of the least marks around it."""
    return words_and_marks(text) + 4


def formatted(turn: tuple[str, str]) -> str:
    return f"[TURN {escape_role(turn[0])}]{escape(turn[1])}[/TURN]"


class Window:
    """One formatted string and what it holds."""

    def __init__(self, system: tuple[str, str] | None, history: list[tuple[str, str]]):
        self.parts, self.mask, self.length = ["<s>"], [], 3
        self.repeated, self.fresh = 0, 0
        for turn in ([system] if system else []) + history:
            self.add(turn, True)

    def add(self, turn: tuple[str, str], repeated: bool = False) -> None:
        role, text = escape_role(turn[0]), escape(turn[1])
        self.parts += ["[TURN ", role, "]", text, "[/TURN]"]
        begin = self.length + 6 + len(role) + 1
        self.length = begin + len(text) + 7
        self.repeated += repeated
        self.fresh += not repeated
        if turn[0] == "assistant" and not repeated:
            self.mask.append((begin, begin + len(text)))

    def text(self) -> str:
        return "".join(self.parts) + "</s>"


def read_back(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted string."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(text)]


def _windows(
    turns: Iterable[tuple[str, str]], budget: int, history: int, count: Callable[[str], int] = words_and_marks
) -> Iterator[Window]:
    """Windows of one conversation, from an iterator over its turns (role, text)."""
    turns, frame = iter(turns), count("<s>") + count("</s>")
    held: list[tuple[str, str]] = []  # the open window's turns, and those before it that may be history
    sums = [0]  # prefix sums of their tokens

    def more() -> bool:
        for turn in turns:
            held.append(turn)
            sums.append(sums[-1] + count(formatted(turn)))
            return True
        return False

    system, own, start, oldest = None, 0, 0, 0
    if more() and held[0][0] == "system":
        system, own, oldest = held[0], sums[1], 1
    first = True
    while start < len(held) or more():
        cost = sums[start + 1] - sums[start]
        lead = None if first or frame + own + cost > budget else system
        used = frame + (own if lead else 0)
        back = start
        if not first:
            back = max(min(oldest, start), bisect_left(sums, sums[start] - max(0, min(history, budget - used - cost)), 0, start + 1))
        used += sums[start] - sums[back]
        while sums[-1] - sums[start] + used <= budget and more():
            pass
        end = max(start + 1, bisect_right(sums, sums[start] + budget - used) - 1)
        window = Window(lead, held[back:start])
        for turn in held[start:end]:
            window.add(turn)
        yield window
        # What is left are the turns that may be history, and those read beyond the window.
        keep = max(min(oldest, end), bisect_left(sums, sums[end] - history, 0, end + 1))
        held, sums = held[keep:], [x - sums[keep] for x in sums[keep:]]
        start, oldest, first = end - keep, max(0, oldest - keep), False


_WINDOW = "conv_id long, window int, text string, n_turns int, n_repeated int, mask array<struct<lo:long,hi:long>>"


def _stream(batches):
    """Turns of sorted batches, by conversation: (conv_id, iterator)."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True)

    for conv, turns in groupby(rows(), key=lambda r: r[0]):
        yield conv, ((r[1], r[2]) for r in turns)


def _format(budget: int, history: int, count: Callable[[str], int]):
    def run(batches):
        names = ["conv_id", "window", "text", "n_turns", "n_repeated", "mask"]
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))]
        out, size = [], 0
        for conv, turns in _stream(batches):
            for k, w in enumerate(_windows(turns, budget, history, count)):
                mask = [{"lo": a, "hi": b} for a, b in w.mask]
                out.append((conv, k, w.text(), w.repeated + w.fresh, w.repeated, mask))
                size += w.length
                if size > 4 << 20 or len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return K.lean(run)


def format_windows(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    budget: int = 512, history: int = 128, count: Callable[[str], int] = words_and_marks,
) -> DataFrame:
    """Formatted windows: conv_id, window, text, n_turns, n_repeated (leading turns that are context only), mask (spans of
    characters of ``text`` under the loss).

    Turns are taken in order of the turn number, NULL first, equal numbers in order of role and text. NULL roles and texts are empty.
    ``count`` gives the tokens of a formatted piece of text, such as a tokenizer's. Rows that repeat are turns of their own. Rows without a conversation id form one conversation.
    """
    ship(turns.sparkSession)
    rows = turns.select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_format(budget, history, count), _WINDOW)


@K.lean
def _digest(batches):
    """Formatted windows in order, read back, to one row per conversation."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "n_repeated", "mask")), strict=True)

    out = []
    for conv, windows in groupby(rows(), key=lambda r: r[0]):
        turns, loss, n_turns, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for _, text, repeated, mask in windows:
            chars += len(text)
            for role, said in read_back(text)[repeated:]:
                n_turns += 1
                turns.update(f"{role}\n{said}\n".encode())
            for span in mask:
                said = unescape(text[span["lo"] : span["hi"]])
                loss_chars += len(said)
                loss.update(said.encode())
        out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if len(out) == 4096:
            yield _digest_batch(out)
            out = []
    if out:
        yield _digest_batch(out)


def _digest_batch(out):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: n_turns, turns_sha256 (role and text of each turn, a line end after each), loss_chars,
    loss_sha256 (all text under the mask, unescaped) and formatted_chars."""
    ship(windows.sparkSession)
    dealt = windows.select("conv_id", "window", "text", "n_repeated", "mask").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return dealt.mapInArrow(_digest, schema)
