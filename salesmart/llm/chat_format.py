"""Conversations as marked-up text with a loss mask, assembled column by column.

A turn is ``<turn:ROLE>``, a line feed, the text, ``</turn>`` and a line feed.
Inside a role or a text every backslash, ``<`` and ``>`` has a backslash before
it, so no text can hold a mark of the template, and taking the backslashes out
again gives back the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .bytescan import buffers, parts

OPEN, MID, CLOSE = b"<turn:", b">\n", b"</turn>\n"
_ESCAPED = np.array([b in b"\\<>" for b in range(256)])
_PART = 1 << 20  # bytes of text that are assembled in one buffer (a longer text alone)
_BLOCK = 1 << 18  # bytes whose places are computed at once


def _escape(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a backslash before every control byte, and the new offsets."""
    extra = sum(int(np.count_nonzero(_ESCAPED[data[lo: lo + _BLOCK]])) for lo in range(0, len(data), _BLOCK))
    out = np.empty(len(data) + extra, np.uint8)
    moved = np.zeros(len(offsets), np.int64)
    base = 0
    for lo in range(0, len(data), _BLOCK):
        block = data[lo: lo + _BLOCK]
        control = _ESCAPED[block]
        shift = np.cumsum(control)
        place = base + np.arange(len(block)) + shift
        out[place] = block
        out[place[control] - 1] = 92
        here = slice(*np.searchsorted(offsets, [lo, lo + len(block)], "right"))
        moved[here] = place[offsets[here] - lo - 1] + 1
        base += len(block) + int(shift[-1])
    return out, moved


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copies piece i of ``data`` to ``out`` at ``at[i]``."""
    shift = at - offsets[:-1]
    for lo in range(0, len(data), _BLOCK):
        hi = min(lo + _BLOCK, len(data))
        first, last = int(np.searchsorted(offsets, lo, "right")) - 1, int(np.searchsorted(offsets, hi, "left"))
        size = np.diff(np.clip(offsets[first: last + 1], lo, hi))
        out[np.repeat(shift[first:last], size) + np.arange(lo, hi)] = data[lo:hi]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted turns as one binary array over one buffer; start and end of each content within its turn."""
    role, role_at = _escape(*buffers(roles))
    text, text_at = _escape(*buffers(texts))
    n = len(role_at) - 1
    lengths = np.empty((n, 5), np.int64)
    lengths[:] = len(OPEN), 0, len(MID), 0, len(CLOSE)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5) if n else np.empty((0, 5), np.int64)
    begins = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for k, mark in ((0, OPEN), (2, MID), (4, CLOSE)):
        out[begins[:, k, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    _scatter(out, begins[:, 1], role, role_at)
    _scatter(out, begins[:, 3], text, text_at)
    offsets = np.concatenate([begins[:, 0], [len(out)]]).astype(np.int64)
    made = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return made, begins[:, 3] - begins[:, 0], ends[:, 3] - begins[:, 0]


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                learned: str = "assistant") -> DataFrame:
    """One row ``conv, turn, nth, formatted, loss_start, loss_end`` for each turn.

    ``formatted`` is the turn's bytes; a conversation is its turns' bytes one
    after the other, by ``turn``, then ``nth``.  The loss mask holds the bytes
    from ``loss_start`` to ``loss_end`` of the turns of ``learned``, and is empty
    for others: the text only, without marks.

    A null role or text is empty.  Turns with the same number follow one another
    by role and text, null first; repeated rows are all kept.  Null
    conversations are one conversation of their own.  Other columns are not read.

    Scale: rows are range-partitioned by conversation, turn, role and text, so a
    conversation with very many turns spreads over tasks; each turn is assembled alone.
    """
    kind = "conv long, turn long, nth long, formatted binary, loss_start long, loss_end long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = TaskContext.get().partitionId() << 33  # turns with one number may lie in two tasks
        for batch in batches:
            for part in parts(batch, "text", _PART):
                made, start, end = assemble(part.column("role"), part.column("text"))
                mine = np.array([r == learned for r in part.column("role").to_pylist()], bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv"), part.column("turn"), pa.array(np.arange(nth, nth + part.num_rows)), made.cast(pa.binary()),
                     pa.array(np.where(mine, start, 0)), pa.array(np.where(mine, end, 0))],
                    names=["conv", "turn", "nth", "formatted", "loss_start", "loss_end"])
                nth += part.num_rows

    rows = turns.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                        F.col(f"`{role}`").cast("string").alias("role"), F.col(f"`{text}`").cast("string").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    # Equal rows fall into one partition, so their order in a task is their order in the conversation.
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, kind)


def _unescaped(data: bytes | memoryview) -> Iterator[bytes]:
    """What ``_escape`` was given, in blocks."""
    body = np.frombuffer(data, np.uint8)
    lo = 0
    while lo < len(body):
        block = body[lo: lo + _BLOCK]
        run = len(block) - 1 - int(np.flatnonzero(block != 92)[-1]) if (block != 92).any() else len(block)
        if run % 2:  # the last backslash belongs to the byte behind it
            block = body[lo: lo + len(block) + 1]
        lo += len(block)
        slash = np.flatnonzero(block == 92)
        if len(slash):
            # In a run of backslashes every second one stands for itself.
            first = np.concatenate([[True], np.diff(slash) != 1])
            begin = slash[np.flatnonzero(first)][np.cumsum(first) - 1]
            keep = np.ones(len(block), bool)
            keep[slash[(slash - begin) % 2 == 0]] = False
            block = block[keep]
        yield block.tobytes()


def unescaped(data: bytes | memoryview) -> bytes:
    """What ``_escape`` was given."""
    return b"".join(_unescaped(data))


def _text_at(data: bytes) -> int:
    """Where the text of a formatted turn starts."""
    if not data.startswith(OPEN) or not data.endswith(CLOSE):
        raise ValueError("not a whole turn")
    at = data.find(MID, len(OPEN))
    while (at - len(data[:at].rstrip(b"\\"))) % 2:  # an escaped mark belongs to the role
        at = data.find(MID, at + 1)
    return at + len(MID)


def parse_turn(data: bytes) -> tuple[bytes, bytes]:
    """Role and text of a formatted turn."""
    at = _text_at(data)
    view = memoryview(data)
    return unescaped(view[len(OPEN): at - len(MID)]), unescaped(view[at: -len(CLOSE)])


def _chars(data: bytes | memoryview) -> int:
    """Code points: every byte of UTF-8 but those that continue one."""
    body = np.frombuffer(data, np.uint8)
    return sum(int(np.count_nonzero(body[lo: lo + _BLOCK] & 0xC0 != 0x80)) for lo in range(0, len(body), _BLOCK))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what can be read back from its formatted turns.

    ``conv, n_turns, turns_sha256`` (role, line feed, text, line feed per turn),
    ``loss_chars, loss_sha256`` (the text under the mask, unescaped) and ``formatted_chars``.

    A digest needs its bytes in order, so a conversation's turns pass through one
    task; they are read as a sorted stream, one turn at a time, and never gathered.
    """
    kind = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        current, state = None, None

        def done(conv, s) -> list:
            return [conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]]

        for part in (p for batch in batches for p in parts(batch, "formatted", _PART)):
            rows = []
            columns = [part.column(c) for c in ("conv", "formatted", "loss_start", "loss_end")]
            for conv, data, start, end in zip(*(c.to_pylist() for c in columns)):
                if state is None or conv != current:
                    if state is not None:
                        rows.append(done(current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                view, at = memoryview(data), _text_at(data)
                state[0] += 1
                state[1].update(unescaped(view[len(OPEN): at - len(MID)]) + b"\n")
                for piece in _unescaped(view[at: -len(CLOSE)]):
                    state[1].update(piece)
                state[1].update(b"\n")
                for piece in _unescaped(view[start:end]):
                    state[2] += _chars(piece)
                    state[3].update(piece)
                state[4] += _chars(view)
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(fields, map(list, zip(*rows)))))
        if state is not None:
            yield pa.RecordBatch.from_pydict(dict(zip(fields, map(list, zip(*[done(current, state)])))))

    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "nth")]
    return formatted.repartition("conv").sortWithinPartitions(*order).mapInArrow(run, kind)


def formatted_digests(turns: DataFrame) -> DataFrame:
    """Formats ``turns``, writes the result and reads it back into digests."""
    return digests(stage(format_chat(turns), "chat"))
