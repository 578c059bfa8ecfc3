"""Token ids of whole documents, in binary files of Simple-8b words."""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import stage, staging_dir
from .blobs import read_blobs, write_blobs
from .bytescan import buffers, parts
from .simple8b import MAGIC, file_bytes, read_file

CACHE_BYTES = 48 << 20  # what a worker may spend on remembering the ids of pieces
FILE_IDS = 4_000_000  # a file is closed after the document that passes this many ids
_SLICE = 4 << 20  # bytes of text that are encoded together
_END = "\n"  # stands behind each file's last byte
_ODD_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: how byte-level vocabularies cut a text into words.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_PLAIN_TOP = "\u024f"  # up to here letters and digits are the same in every Unicode version


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_LETTERS = _byte_letters()
_POINTS = ".,;:!?"


def _four_bytes(ids) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


class Encoder:
    """Ids of texts by a vocabulary file of the tokenizers library, special tokens read as ordinary text.

    A byte-level pattern never joins text across a single blank between two
    words, nor across a single line feed between two words; so texts are cut
    there, each different piece of many texts is encoded once, and the ids of
    pieces seen lately are remembered.  Where white space at a piece's
    edge could join its neighbour's, the text is cut at single blanks only.
    Other vocabularies encode whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        made = json.loads(self.library.to_str())
        pre = made.get("pre_tokenizer") or {}
        self.by_piece = (made.get("normalizer") is None and made.get("post_processor") is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex", True) and not pre.get("add_prefix_space", True))
        self.model = self.library.model
        self.pieces = pa.array([], pa.large_binary())
        self.flat, self.size = np.empty(0, "<u4"), np.empty(0, np.int64)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: bytes) -> bytes:
        return _four_bytes([t.id for t in self.model.tokenize(word.decode("latin-1").translate(_LETTERS))])

    def _piece(self, piece: bytes) -> bytes:
        """Ids of a piece; none for one that must not stand alone, as white space at its edge could join its neighbour's."""
        text = piece.decode()
        core = text.removeprefix(" ")
        if core and max(core) <= _PLAIN_TOP:
            if core.isalpha():
                return self._word(piece)
            if core[-1] in _POINTS and core[:-1].isalpha():
                return self._word(piece[:-1]) + self._word(piece[-1:])
            if core.strip() == core and len(core.split()) == 1:
                return b"".join([self._word(w.encode()) for w in _WORDS.findall(text)])
        if text != "\n" and (not core or core != core.strip()):
            return b""
        return self.whole([text])[0]

    def _learned(self, piece: bytes) -> bytes:
        core = piece[1:] if piece[:1] == b" " else piece
        if core.isalpha():  # for bytes, ASCII letters: nearly half of all
            word = core.decode()
            return _four_bytes([t.id for t in self.model.tokenize(word if core is piece else _LETTERS[32] + word)])
        return self._piece(piece)

    def _ids(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the remembered pieces in a row, where each piece's begin, and how many it has.

        Pieces are remembered in two Arrow arrays, some 40 bytes each; when they
        fill ``CACHE_BYTES``, the half learned first is forgotten.
        """
        if len(self.pieces) and self.pieces.nbytes + self.flat.nbytes + self.size.nbytes > CACHE_BYTES:
            half = len(self.pieces) // 2
            self.pieces = pa.concat_arrays([self.pieces[half:]])
            self.flat, self.size = self.flat[int(self.size[:half].sum()):].copy(), self.size[half:].copy()
        at = pc.index_in(pieces, value_set=self.pieces).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            unknown = pieces.take(pa.array(new))
            flat, size = _joined([self._learned(p) for p in unknown.to_pylist()])
            at[new] = len(self.pieces) + np.arange(len(new))
            self.pieces = pa.concat_arrays([self.pieces, unknown])
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])
        return self.flat, (np.cumsum(self.size) - self.size)[at], self.size[at]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has; a null text has none."""
        data, offsets = buffers(texts)
        if not self.by_piece or not len(data):
            return _joined(self.whole([data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]))
        # A piece starts with each text, at each blank, and at and behind each line feed.
        cuts = np.flatnonzero((data == 32) | (data == 10))
        feed = data[cuts] == 10
        starts = np.repeat(cuts, 1 + feed)
        starts[np.cumsum(1 + feed)[feed] - 1] += 1
        upto = np.concatenate([[0], np.cumsum(1 + feed)])[np.searchsorted(cuts, offsets)]  # pieces cut before each text
        starts = np.insert(starts, upto[:-1], offsets[:-1])
        first = upto[:-1] + np.arange(len(offsets) - 1)
        bounds = np.append(starts, len(data))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        flat, begin, size = self._ids(coded.dictionary)
        n = size[at]
        ends = np.cumsum(n)
        ids = flat[np.repeat(begin[at] - (ends - n), n) + np.arange(ends[-1])]
        lengths = np.add.reduceat(n, first)
        odd = np.flatnonzero(np.logical_or.reduceat(n == 0, first) & (offsets[:-1] < offsets[1:]))
        if not len(odd):
            return ids, lengths
        each = np.split(ids, np.cumsum(lengths)[:-1])
        for k in odd.tolist():
            head, *rest = _ODD_SPACE.split(data[offsets[k]: offsets[k + 1]].tobytes().decode())
            each[k] = _joined(self.whole([head, *[" " + r for r in rest]]))[0]
        return np.concatenate(each), np.array([len(e) for e in each])


def _joined(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(coded), "<u4"), np.fromiter(map(len, coded), np.int64, len(coded)) // 4


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int | None = 2, doc_id: str = "doc_id", text: str = "text",
                      file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of ``docs`` in ascending order of id to ``folder``; returns ``file, n_docs, n_ids`` of each file.

    A null text is empty, ``end_id`` ends every document.  Null ids come first;
    rows with the same id follow one another by text; repeated rows are all
    written.  Other columns are not read.  An empty table makes no file with ids.

    Scale: documents are range-partitioned by id, so files, in the order of
    task and number within it, are in the order of ids.  Each task writes its
    own files, a document never spans two.  Spark's writer commits them, in any
    store it knows, so lost executors and speculative copies do no harm.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        names, held, lengths, n = [], [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal names, held, lengths, n
            body = file_bytes(np.concatenate(held), names, lengths)
            names, held, lengths, n = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["body"])

        for batch in batches:
            for part in parts(batch, "text", _SLICE):
                ids, size = encode(part.column("text"))
                if end_id is not None:
                    ids, size = np.insert(ids, np.cumsum(size), end_id), size + 1
                ends, docs_here, lo = np.cumsum(size), part.column("id").to_pylist(), 0
                while lo < len(size):
                    before = int(ends[lo] - size[lo])
                    hi = min(len(size), int(np.searchsorted(ends, before + file_ids - n)) + 1)
                    held.append(ids[before: ends[hi - 1]])
                    names += docs_here[lo:hi]
                    lengths += size[lo:hi].tolist()
                    n += int(ends[hi - 1]) - before
                    lo = hi
                    if n >= file_ids:
                        yield closed()
        if names:
            yield closed()
        pa.default_memory_pool().release_unused()  # the worker lives on, its scratch memory need not

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    placed = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    write_blobs(placed.mapInArrow(run, "body binary"), folder, _END)
    return token_files(docs.sparkSession, folder)


def _body(content: pa.Scalar) -> memoryview:
    return memoryview(content.as_buffer())[: -len(_END)]


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, n_docs, n_ids`` of the files in ``folder``, from their indexes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                body = _body(content)
                size = struct.unpack_from("<Q", body, len(body) - len(MAGIC) - 8)[0]
                _, n_docs, n_ids = struct.unpack_from("<QQQ", body, len(body) - len(MAGIC) - 8 - size)
                yield pa.RecordBatch.from_pydict({"file": [path.rpartition("/")[2]], "n_docs": [n_docs], "n_ids": [n_ids]})

    return read_blobs(spark, folder).mapInArrow(run, "file string, n_docs long, n_ids long")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row ``id, start, n_tokens, ids_crc32`` per document of the files in ``folder``.

    ``start`` counts the ids of all documents before.  Inside a file it is a
    running sum; a file is shifted by the files before it of the same writing
    task, a task's files by all tasks before.  Null ids, repeated ids and rows
    without ids come back as they were written; a folder without files gives no row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                ids, docs, lengths = read_file(_body(content), "<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.rpartition("/")[2]] * len(docs)), pa.array(docs, pa.int64()), pa.array(begins), pa.array(lengths),
                     pa.array(crc, pa.int64())], names=["file", "id", "inside", "n_tokens", "ids_crc32"])

    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("int")
    read = read_blobs(spark, folder).mapInArrow(run, "file string, id long, inside long, n_tokens long, ids_crc32 long")
    read = read.select(number(r"^part-(\d+)-").alias("task"), number(r"-c(\d+)\.").alias("nth"), "id", "inside", "n_tokens", "ids_crc32")
    read = stage(read, "read-ids")
    files = read.groupBy("task", "nth").agg(F.sum("n_tokens").alias("n"))
    tasks = files.groupBy("task").agg(F.sum("n").alias("all"))
    tasks = tasks.select("task", (F.sum("all").over(Window.orderBy("task")) - F.col("all")).alias("before"))  # a row a task, not a file
    within = F.sum("n").over(Window.partitionBy("task").orderBy("nth")) - F.col("n")
    shift = files.select("task", "nth", within.alias("shift")).join(tasks, "task").select("task", "nth", (F.col("shift") + F.col("before")).alias("shift"))
    return read.join(shift, ["task", "nth"]).select("id", (F.col("inside") + F.col("shift")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(docs: DataFrame, vocabulary: str, end_id: int | None = 2, doc_id: str = "doc_id", text: str = "text",
              folder: str | None = None) -> DataFrame:
    """Writes ``docs`` as token-id files and reads them back; an empty table gives no file and no row."""
    spark = docs.sparkSession
    folder = folder or staging_dir(spark, "token-ids")
    write_token_files(docs, vocabulary, folder, end_id, doc_id, text)
    return read_token_files(spark, folder)
