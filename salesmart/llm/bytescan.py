"""Words of many texts at once, as numpy arrays over the texts' bytes.

A word is a run of bytes that a 256-entry table admits.  Bytes of letters
beyond ASCII are all 128 or more, so a table over bytes is exact for UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_CHUNK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Admits 0-9, A-Z, a-z and every byte of a non-ASCII letter.
LETTERS = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Admits everything but ASCII white space.
INK = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string array and its offsets; nulls are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]] if len(texts) else np.empty(0, np.uint8)
    return data, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def parts(batch: pa.RecordBatch, column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes of ``column``, a single long text alone, so that
    the arrays over a slice's bytes stay small however many rows a batch has."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def stretches(batch: pa.RecordBatch, column: str, admits: np.ndarray, overlap: int,
              most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``data, offsets, rows, old``: the texts of ``column`` in stretches of about ``most`` bytes, long texts in several.

    A long text is cut behind a word, never inside one (words are runs that
    ``admits`` lets pass), and its next stretch starts with the last ``overlap``
    words again, so that runs of words over a cut are seen.  ``rows`` names each
    piece's row in the batch, ``old`` how many words at its start were seen before.
    """
    if not batch.num_rows:
        return
    data, offsets = buffers(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        a, b = int(offsets[lo]), int(offsets[hi])
        if hi > lo + 1 or b - a <= most:
            yield data[a:b], offsets[lo: hi + 1] - a, np.arange(lo, hi), np.zeros(hi - lo, np.int64)
        else:
            for piece, seen in cut(data[a:b], admits, overlap, most):
                yield piece, np.array([0, len(piece)]), np.array([lo]), np.array([seen])
        lo = hi


def cut(data: np.ndarray, admits: np.ndarray, overlap: int, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """One text in pieces of about ``most`` bytes that end behind a word, and how many words of each were in the last one.

    A piece starts with the ``overlap`` words before it, or with all of them if there are fewer.
    """
    lo, hi, seen = 0, 0, 0
    while True:
        hi = max(lo, hi) + most
        while hi < len(data) and admits[data[hi]]:  # on to the end of the word
            gap = np.flatnonzero(~admits[data[hi: hi + most]])
            hi += int(gap[0]) if len(gap) else most
        hi = min(hi, len(data))
        yield data[lo:hi], seen
        if hi == len(data):
            return
        starts = _last_starts(data, lo, hi, admits, overlap)
        seen = len(starts)
        lo = starts[0] if seen else hi


def _last_starts(data: np.ndarray, lo: int, hi: int, admits: np.ndarray, n: int) -> list[int]:
    """Where the last ``n`` words of ``data[lo:hi]`` start, or all if there are fewer, looked for from the end in blocks."""
    found: list[int] = []
    size = 4096
    while hi > lo and len(found) < n:
        at = max(lo, hi - size)
        first = admits[data[at:hi]]
        first[1:] &= ~first[:-1]
        first[0] &= at == lo or not admits[data[at - 1]]
        found = (np.flatnonzero(first) + at).tolist() + found
        hi, size = at, min(4 * size, _CHUNK)
    return found[-n:] if n else []


def spans(data: np.ndarray, offsets: np.ndarray, admits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each text (one more at the end)."""
    inside = admits[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    start[first] = inside[first]  # words end with their text
    end[last] = inside[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _ODD)]))


def _inverse(n: int) -> np.ndarray:
    inv = np.uint64(pow(int(_ODD), -1, 1 << 64))
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, inv)]))


_TABLES: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return h ^ (h >> np.uint64(29))


def _letters(data: np.ndarray) -> np.ndarray:
    return LOWER[data].astype(np.uint64) + np.uint64(1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word, A-Z in lower case, a megabyte of bytes at a time, however long a word is."""
    if not _TABLES:
        _TABLES.extend([_powers(_CHUNK + 1), _inverse(_CHUNK + 1)])
    power, inverse = _TABLES
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        stop = int(np.searchsorted(ends, lo + _CHUNK, "right"))
        if stop <= at:  # a word longer than a chunk: the sum of its chunks
            total = 0
            for k in range(lo, int(ends[at]), _CHUNK):
                block = _letters(data[k: min(k + _CHUNK, int(ends[at]))])
                total += int((block * power[: len(block)]).sum()) * pow(int(_ODD), k - lo, 1 << 64)
            out[at] = total & ((1 << 64) - 1)
            at += 1
            continue
        hi = int(ends[stop - 1])
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_letters(data[lo:hi]) * power[: hi - lo], out=sums[1:])
        s, e = starts[at:stop] - lo, ends[at:stop] - lo
        out[at:stop] = (sums[e] - sums[s]) * inverse[s]
        at = stop
    return mixed(out)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words; the last ones of a text reach into the next text."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = words[:n].copy()
    for k in range(1, width):
        h = mixed(h * _ODD + words[k: n + k])
    return h * _ODD + np.uint64(width)
