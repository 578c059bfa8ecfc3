"""Near-duplicate groups by 64-bit SimHash, searched through pivot distance tables.

A pivot table holds each fingerprint's Hamming distances to fixed reference
fingerprints.  By the triangle inequality two fingerprints at most ``max_bits``
apart differ by at most ``max_bits`` in every one of these coordinates, so pairs
with a larger coordinate difference are discarded, and the survivors verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .bytescan import INK, cut
from .text import packed, unpacked

PIVOTS = 8
BYTES = 8
_BLOCK = 1 << 16  # shingles whose bits are unpacked at once
_PIECE = 1 << 20  # bytes of a text whose words are held at once


def pivots(n: int = PIVOTS, seed: int = 7) -> list[int]:
    """Reference fingerprints, as unsigned integers."""
    return [int(v) for v in np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)]


def _spans_hashed(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of every ``width`` consecutive words, some at a time."""
    if sum(map(len, words)) > 4 * _PIECE:  # words too long to be joined
        for k in range(len(words) - width + 1):
            h = xxhash.xxh64(words[k], seed=42)
            for w in words[k + 1: k + width]:
                h.update(b" ")
                h.update(w)
            yield np.array([h.intdigest()], "<u8")
        return
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    end = (start + size)[width - 1:].tolist()
    start = start[: len(words) - width + 1].tolist()
    for at in range(0, len(start), _BLOCK):
        spans = map(slice, start[at: at + _BLOCK], end[at: at + _BLOCK])
        yield np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(42)), "<u8", min(_BLOCK, len(start) - at))


def _words(text: bytes | pa.Buffer, width: int) -> Iterator[list[bytes]]:
    """The words of a text, a long one in pieces that begin with the last ``width - 1`` words of the one before."""
    if len(text) <= _PIECE:
        yield bytes(text).lower().split()  # for bytes both touch ASCII only
        return
    for piece, _ in cut(np.frombuffer(text, np.uint8), INK, width - 1, _PIECE):
        yield piece.tobytes().lower().split()


def fingerprint(text: bytes | pa.Buffer | None, width: int = 3) -> int:
    """SimHash of a text over XXH64 (seed 42) of its word shingles, as an unsigned integer.

    Words are runs without ASCII white space, A-Z in lower case.  Fewer words
    than ``width`` are one shingle; none give zero.  The words of a megabyte are
    held at a time, however long the text.
    """
    ones, n, words = np.zeros(64, np.int64), 0, []
    for words in _words(text or b"", width):
        if len(words) < width:
            continue
        for h in _spans_hashed(words, width):
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
        words = []  # not held while the next piece is cut
    if not n:  # fewer than width words: the last piece has them all
        if not words:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """One row ``id, of, fp`` for each row: ``of`` is a hash of its text, ``fp`` the 64 bits as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            fps = np.fromiter((fingerprint(t.as_buffer(), width) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("of"), pa.array(fps)], names=["id", "of", "fp"])

    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(body).alias("of"), body.cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, of long, fp long")


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fp, far``: the distances to the eight references, one byte each in a long."""
    signed = [int(np.uint64(p).view(np.int64)) for p in pivots()]
    far = F.lit(0).cast("long")
    for k, p in enumerate(signed):
        far = far.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long"), 8 * k))
    return fps.select("fp", far.alias("far"))


def _within(a: Column, b: Column, most: int) -> Column:
    """No coordinate of two packed rows of the pivot table differs by more than ``most``."""
    byte = lambda c, k: F.shiftright(c, 8 * k).bitwiseAND(F.lit(255))
    ok = F.lit(True)
    for k in range(PIVOTS):
        ok = ok & (F.abs(byte(a, k) - byte(b, k)) <= most)
    return ok


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints at most ``max_bits`` apart, none lost.

    Differing bits lie in at most ``max_bits`` of the eight bytes, so a linked
    pair agrees in some choice of the others: it meets under the masked
    fingerprint of that choice.  Such a group holds no more than
    ``256 ** max_bits`` fingerprints, however many documents there are, and
    within it pairs are discarded by their pivot distances first.

    The keyed side is never broadcast: Spark takes it for the size of the table
    it is exploded from, a 28th of its rows for two bits.
    """
    if not 1 <= max_bits <= 3:
        raise ValueError("max_bits must be 1, 2 or 3")
    table = stage(pivot_table(fps), "pivots")
    keys = []
    for n, free in enumerate(combinations(range(BYTES), max_bits)):
        mask = ((1 << 64) - 1) ^ sum(255 << (8 * f) for f in free)
        keys.append(F.struct(F.lit(n).cast("byte").alias("n"),
                             F.col("fp").bitwiseAND(F.lit(int(np.uint64(mask).view(np.int64)))).alias("m")))
    keyed = table.select("fp", "far", F.explode(F.array(*keys)).alias("key")).select("fp", "far", "key.n", "key.m")
    a, b = keyed.alias("a"), keyed.alias("b")
    near = ((F.col("a.n") == F.col("b.n")) & (F.col("a.m") == F.col("b.m")) & (F.col("a.fp") < F.col("b.fp"))
            & _within(F.col("a.far"), F.col("b.far"), max_bits)
            & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits))
    return a.join(b.hint("merge"), near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``edges`` (``a, b``); root is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours, then the
    label of that label.  Edges are never rewritten, so no hub arises: a
    fingerprint has a bounded number of neighbours.  Every round is written to
    the shared folder, and rounds end when no label changes.
    """
    both = stage(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")), "links")
    label = stage(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v"))
                  .select("node", F.least("node", "v").alias("root")), "labels")
    while True:
        around = both.join(label.select(F.col("node").alias("v"), "root"), "v").groupBy("u").agg(F.min("root").alias("near"))
        hooked = stage(label.join(around, label.node == around.u)
                       .select("node", F.least("root", "near").alias("root"), F.col("root").alias("was")), "labels")
        above = hooked.select(F.col("node").alias("up"), F.col("root").alias("top"))
        label = stage(hooked.join(above, hooked.root == above.up).select("node", F.col("top").alias("root"), "was"), "labels")
        if label.where("root <> was").isEmpty():
            return label.select("node", "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row ``id, of, fingerprint, component_id`` for each row of ``docs``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest id that can be reached, the own included.
    Null and empty texts have the fingerprint zero and are linked like others.
    Null ids take part but are never the smallest; a component of null ids alone
    has a null ``component_id``.  Repeated rows share a component.  Only the two
    named columns are read, so other columns cannot clash.

    Scale: copies fold into one row per distinct fingerprint before anything is
    paired; only ids and fingerprints are shuffled, never texts.
    """
    marks = stage(fingerprints(docs, doc_id, text, width), "fingerprints")
    classes = stage(marks.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    roots = components(links(classes.select("fp"), max_bits))
    linked = stage(classes.join(roots, classes.fp == roots.node, "left")
                   .select("fp", "first", F.coalesce("root", "fp").alias("root")), "linked")
    least = stage(linked.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    named = stage(linked.join(least, "root").select("fp", "component_id"), "component-ids")
    return marks.join(named, "fp").select("id", "of", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id.

    Among repeated rows of that id the smallest text hash stays, among identical
    texts the row whose columns hash lowest.  A group of null ids alone keeps one row.
    """
    found = near_duplicates(docs, doc_id, text, width, max_bits)
    # Null ids differ in group by fingerprint only: such groups have no smallest id.
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("fp"))
    kept = found.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "of")).alias("w"))
    kept = stage(kept.select(F.col("w.id").alias("id"), F.col("w.of").alias("of")).distinct(), "kept-ids")
    rows = packed(docs, k=F.col(f"`{doc_id}`").cast("long"), h=F.xxhash64(F.col(f"`{text}`")))
    rows = rows.join(kept, (rows.h == kept.of) & rows.k.eqNullSafe(kept.id), "left_semi")
    first = Window.partitionBy("k", "h").orderBy(F.xxhash64(*[f"in_{k}" for k in range(len(docs.columns))]))
    return unpacked(rows.withColumn("nth", F.row_number().over(first)).where("nth = 1"), docs.columns)
