"""Simple-8b word-aligned coding of whole numbers, vectorised both ways.

A 64-bit word has a selector in its top four bits and up to 60 bits of payload:
the selector says how many numbers of how many bits it packs, lowest first.
Numbers are coded in blocks that do not depend on each other.  A number of more
than 60 bits is an escape word; its value stands in the block's escape list.
"""

from __future__ import annotations

import struct

import numpy as np

# Selector, from 0 on: numbers per word, bits per number.  Fixed values of the coding.
PACKS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
BLOCK = 1024  # numbers in a block
_AT_ONCE = 256  # blocks that are coded or decoded together
_HEAD = struct.Struct("<3I")  # numbers, words, escapes
_U = np.uint64
_HELD = np.array([p[0] for p in PACKS] + [0] * (ESCAPE - len(PACKS)) + [1])  # numbers in a word of each selector


def _choices(values: np.ndarray) -> np.ndarray:
    """The selector packing most numbers that fits at each place; rows are blocks, zeros follow their ends."""
    width = values.shape[1]
    # The exponent is the bit length; where rounding makes it one too large, the number only gets a wider word.
    need = np.zeros((len(values), width + PACKS[0][0]), np.uint8)
    need[:, :width] = np.frexp(values.astype(np.float64))[1]
    best = np.full(values.shape, ESCAPE, np.uint8)
    widest, n = need[:, :width].copy(), 1  # the most bits among the next n numbers
    for selector in range(len(PACKS) - 1, -1, -1):
        count, bits = PACKS[selector]
        while n < count:
            np.maximum(widest, need[:, n: n + width], out=widest)
            n += 1
        fits = widest <= bits
        if not fits.any():
            break
        best[fits] = selector
    return best


def encode_blocks(values: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """The coded blocks of ``values`` (unsigned), each of ``block`` numbers but the last."""
    out = []
    for lo in range(0, len(values), block * _AT_ONCE):
        part = np.ascontiguousarray(values[lo: lo + block * _AT_ONCE], _U)
        n = -(-len(part) // block)
        wide = np.zeros((n, block + PACKS[0][0]), _U)
        padded = np.zeros(n * block, _U)
        padded[: len(part)] = part
        padded = padded.reshape(n, block)
        wide[:, :block] = padded
        count = np.full(n, block)
        count[-1] = len(part) - (n - 1) * block
        best = _choices(padded)
        # All blocks walk their words in step.
        at, row, begins = np.zeros(n, np.int64), np.arange(n), np.zeros((n, block), bool)
        while len(row):
            begins[row, at] = True
            at = at + _HELD[best[row, at]]
            more = at < count[row]
            row, at = row[more], at[more]
        rows, places = np.nonzero(begins)
        chosen = best[rows, places]
        words = chosen.astype(_U) << _U(60)
        for selector, (k, bits) in enumerate(PACKS):
            mine = np.flatnonzero(chosen == selector)
            if len(mine):
                for j in range(k):
                    words[mine] |= wide[rows[mine], places[mine] + j] << _U(j * bits)
        cut = np.searchsorted(rows, np.arange(n + 1))
        large = chosen == ESCAPE
        for b in range(n):
            mine = slice(cut[b], cut[b + 1])
            more = padded[b, places[mine][large[mine]]]
            out.append(_HEAD.pack(int(count[b]), int(cut[b + 1] - cut[b]), len(more)) + words[mine].astype("<u8").tobytes() + more.astype("<u8").tobytes())
    return out


def decode_blocks(data, offsets: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The numbers of the blocks that begin at ``offsets`` of ``data``, one block after the other."""
    done = []
    for lo in range(0, len(offsets), _AT_ONCE):
        heads = [(int(o), *_HEAD.unpack_from(data, int(o))) for o in offsets[lo: lo + _AT_ONCE]]
        words = np.concatenate([np.frombuffer(data, "<u8", w, o + _HEAD.size) for o, _, w, _ in heads])
        large = np.concatenate([np.frombuffer(data, "<u8", e, o + _HEAD.size + 8 * w) for o, _, w, e in heads])
        count, n_words = np.array([h[1] for h in heads]), np.array([h[2] for h in heads])
        chosen = (words >> _U(60)).astype(np.int64)
        held = _HELD[chosen]
        # A block's last word may be padded: words start where their block's numbers start, and padding is cut off.
        upto = np.concatenate([[0], np.cumsum(held)])
        first_word = np.cumsum(n_words) - n_words
        full = upto[first_word + n_words] - upto[first_word]
        begin = upto[:-1]
        out = np.zeros(int(upto[-1]), kind)
        for selector, (k, bits) in enumerate(PACKS):
            mine = np.flatnonzero(chosen == selector)
            if len(mine):
                own, at, mask = words[mine], begin[mine], _U((1 << bits) - 1)
                for j in range(k):
                    out[at + j] = (own >> _U(j * bits)) & mask
        out[begin[chosen == ESCAPE]] = large
        if (full == count).all():
            done.append(out)
        else:
            start = np.cumsum(full) - full
            done += [out[s: s + c] for s, c in zip(start.tolist(), count.tolist())]
    return np.concatenate(done) if done else np.empty(0, kind)


MAGIC = b"S8BIDS01"


def file_bytes(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], block: int = BLOCK) -> bytes:
    """A whole file: magic, blocks, index, the index' length, magic.

    The index holds the number of blocks and documents, each block's offset in
    the file, and each document's id, null mark and number of token ids.
    """
    blocks = encode_blocks(ids, block)
    sizes = np.array([len(b) for b in blocks], np.int64)
    offsets = len(MAGIC) + np.cumsum(sizes) - sizes
    index = b"".join([
        struct.pack("<QQQ", len(blocks), len(doc_ids), len(ids)), offsets.astype("<u8").tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(), np.array(lengths, "<u8").tobytes()])
    return b"".join([MAGIC, *blocks, index, struct.pack("<Q", len(index)), MAGIC])


def read_file(data, kind: str = "<u8") -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """Token ids (as numbers of ``kind``), document ids and number of token ids of each document."""
    data = memoryview(data)
    if data[: len(MAGIC)] != MAGIC or data[-len(MAGIC):] != MAGIC:
        raise ValueError("not a whole token-id file")
    size = struct.unpack_from("<Q", data, len(data) - len(MAGIC) - 8)[0]
    at = len(data) - len(MAGIC) - 8 - size
    n_blocks, n_docs, n_ids = struct.unpack_from("<QQQ", data, at)
    offsets = np.frombuffer(data, "<u8", n_blocks, at + 24)
    at += 24 + 8 * n_blocks
    docs = np.frombuffer(data, "<i8", n_docs, at).tolist()
    null = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
    lengths = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
    ids = decode_blocks(data, offsets, kind)
    if len(ids) != n_ids:
        raise ValueError("blocks and index disagree")
    return ids, [None if z else d for d, z in zip(docs, null)], lengths
