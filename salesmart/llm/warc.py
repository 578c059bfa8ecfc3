"""WARC archives of pages, compressed record by record with a shared Zstandard dictionary.

The dictionary is built from some of the archived records themselves.  Each
file starts with it, in a skippable frame that other readers pass over, and
every record is a frame of its own.  Equal payloads are stored once: one page
holds the response, the others are revisits that name it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import stage, staging_dir
from .blobs import read_blobs, write_blobs

# The frame that holds a dictionary, an empty skippable frame as text, the start of a compressed frame.
_DICTIONARY_FRAME = 0x184D2A5D
_END = "P*M\x18\0\0\0\0"
_COMPRESSED = b"\x28\xb5\x2f\xfd"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 << 10
SAMPLES, SAMPLE_BYTES = 1_000, 32 << 10  # records the dictionary is built from, and the longest of them: 32 MB at most
FILE_BYTES = 32 << 20  # a file is closed after the record that passes this
_PIECE = 1 << 20


def record_name(page: int | None, digest: str) -> str:
    """URI of a page's record; the same page with the same payload has the same name."""
    return f"urn:page:{'' if page is None else page}:{digest}"


def _uri(text: str) -> str:
    """Blanks and control characters as percent codes, so that a header stays one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page: int | None, url: str | None, payload: bytes | None, size: int, sha1: str, date: str, refers_to: int | None = None,
           refers_url: str | None = None) -> bytes:
    """One WARC record; with ``payload`` None a revisit of ``refers_to``.  ``sha1`` is in hexadecimal digits."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    name = record_name(page, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = {"WARC-Type": "response" if payload is not None else "revisit", "WARC-Target-URI": _uri(url) if url else name,
              "WARC-Date": date, "WARC-Record-ID": f"<{name}>", "WARC-Payload-Digest": f"sha1:{digest}"}
    if payload is None:
        target = record_name(refers_to, digest)
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<{target}>",
                   "WARC-Refers-To-Target-URI": _uri(refers_url) if refers_url else target, "WARC-Refers-To-Date": date}
    body = payload or b""
    fields |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(http) + len(body))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return b"".join([head.encode(), http, body, b"\r\n\r\n"])


def dictionary_frame(dictionary: bytes) -> bytes:
    """The dictionary, compressed, in a skippable frame."""
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", _DICTIONARY_FRAME, len(packed)) + packed


def opened(archive: memoryview) -> io.BufferedReader:
    """The records of an archive, uncompressed, as one stream; a leading dictionary is used."""
    options = {}
    if len(archive) >= 8:
        magic, size = struct.unpack_from("<II", archive)
        if magic == _DICTIONARY_FRAME:
            dictionary = bytes(archive[8: 8 + size])
            if dictionary.startswith(_COMPRESSED):
                dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
            archive = archive[8 + size:]
    return io.BufferedReader(zstandard.ZstdDecompressor(**options).stream_reader(archive, read_across_frames=True), _PIECE)


def _fields(stream: io.BufferedReader) -> dict[str, str] | None:
    """Header lines up to an empty one, by their names in lower case; None at the end of the stream."""
    if not stream.readline():
        return None
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], int, str]]:
    """Header fields, payload size and payload SHA-1 (base 32) of each record, read in pieces.

    A response's size and digest come from its payload, a revisit's from its headers.
    A payload that does not match its record's digest is an error.
    """
    while (fields := _fields(stream)) is not None:
        left = int(fields["content-length"])
        before = stream.tell()
        http = _fields(stream) or {}
        left -= stream.tell() - before
        claimed = fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "response":
            size, sha1 = left, hashlib.sha1(usedforsecurity=False)
            while left:
                piece = stream.read(min(left, _PIECE))
                if not piece:
                    raise ValueError(f"{fields['warc-record-id']} is cut short")
                sha1.update(piece)
                left -= len(piece)
            digest = base64.b32encode(sha1.digest()).decode()
            if digest != claimed:
                raise ValueError(f"{fields['warc-record-id']} does not match its digest")
        else:
            size, digest = int(http["content-length"]), claimed
            stream.read(left)
        stream.read(4)
        yield fields, size, digest


def _page(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return int(page) if page else None


def _payloads(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """``id, url, payload, size, same``: ``same`` is equal for equal payloads only."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("payload"))
    return rows.withColumns({"size": F.octet_length("payload").cast("long"), "same": F.unhex(F.sha2("payload", 256))})


def _dictionary(rows: DataFrame, kinds: DataFrame, date: str) -> bytes | None:
    """A dictionary from records of different payloads, or None where there are too few to learn from.

    Payloads are taken in the order of a hash: at most ``SAMPLES``, none longer
    than ``SAMPLE_BYTES``, so the driver holds a bounded sample of any archive.
    """
    fit = kinds.where((F.col("size") > 0) & (F.col("size") <= SAMPLE_BYTES)).select("same", F.pmod(F.xxhash64("same"), F.lit(1 << 31)).alias("h"))
    share = min(1.0, 4 * SAMPLES / max(1, fit.count()))  # so that tasks need not each send a whole sample
    chosen = fit.where(F.col("h") < int(share * (1 << 31))).orderBy("h", "same").limit(SAMPLES).select("same")
    found = rows.join(F.broadcast(chosen), "same", "left_semi").groupBy("same").agg(F.min(F.struct("id", "url", "payload")).alias("r"))
    samples = [record(r.id, r.url, bytes(r.payload), len(r.payload), hashlib.sha1(r.payload, usedforsecurity=False).hexdigest(), date)
               for r in found.select("same", "r.*").orderBy("same").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return None


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", *, least: int = 1000,
               date: str = "2000-01-01T00:00:00Z", level: int = 3, file_bytes: int = FILE_BYTES) -> None:
    """Writes one WARC record per row of ``pages`` to files in ``folder``.

    Of the rows with equal payloads of at least ``least`` bytes, that with the
    largest id becomes a response, the others revisit it.  Shorter payloads are
    all responses.  A null payload is empty.  A null id is smaller than any;
    where a payload has null ids alone, all its rows are responses.  Rows that
    repeat the largest id with its payload are responses too, under the same
    record name.  A null url is replaced by the record's name.  An empty table
    makes files without records.  Only the named columns are read.

    Scale: payloads meet as SHA-256 digests, combined on the map side, so a
    payload that a third of all pages hold is one row a task.  Only payloads
    found more than once are joined back, by broadcast where Spark measures that
    they are few, else with skewed keys split.  Each task writes files of about
    ``file_bytes``; the dictionary is trained on a bounded sample.
    """
    rows = _payloads(pages, page_id, url, payload)
    kinds = stage(rows.groupBy("same").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "url")).alias("last")),
                  "payloads")
    dictionary = _dictionary(rows, kinds, date)
    shared = kinds.where((F.col("n") > 1) & (F.col("size") >= least) & F.col("last.id").isNotNull())
    shared = stage(shared.select("same", F.col("last.id").alias("last"), F.col("last.url").alias("last_url")), "shared-payloads")
    again = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    judged = rows.join(shared, "same", "left").select(
        "id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", F.sha1("payload").alias("sha1"),
        F.when(again, F.col("last")).alias("last"), F.when(again, F.col("last_url")).alias("last_url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level, **({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))
        first = [dictionary_frame(dictionary)] if dictionary else []
        frames, size = list(first), 0
        for batch in batches:
            for r in zip(*[batch.column(k) for k in range(batch.num_columns)]):
                page, link, body, length, sha1, last, last_link = (v.as_py() for v in r)
                frames.append(packer.compress(record(page, link, body, length, sha1, date, last, last_link)))
                size += len(frames[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], names=["body"])
                    frames, size = list(first), 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], names=["body"])

    write_blobs(judged.mapInArrow(run, "body binary"), folder, _END)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row ``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` per record of the archives in ``folder``.

    The digest is the SHA-1 of the payload in lower-case hexadecimal digits;
    every response is hashed anew and compared with its header.
    """
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])

        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, size, digest in records(opened(memoryview(content.as_buffer()))):
                    refers = fields.get("warc-refers-to")
                    rows.append((_page(fields["warc-record-id"]), fields["warc-target-uri"], size, base64.b32decode(digest).hex(),
                                 fields["warc-type"], _page(refers) if refers else None))
                    if len(rows) == 4096:
                        yield made(rows)
                        rows = []
                if rows:
                    yield made(rows)

    return read_blobs(spark, folder).select("content").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None, **options) -> DataFrame:
    """Writes ``pages`` to archives and reads them back; see ``write_warc`` and ``read_warc``."""
    spark = pages.sparkSession
    folder = folder or staging_dir(spark, "warc")
    write_warc(pages, folder, page_id, url, payload, **options)
    return read_warc(spark, folder)
