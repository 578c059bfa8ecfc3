"""Passages of benchmark items inside documents, by a prefix-filtered set join.

An item is cut into windows of consecutive words.  A window is a set of word
shingles, all of which a document must contain, so a prefix of one shingle is
enough: the one that is rarest in the corpus.  Only places where a document has
such a shingle are joined with the windows; positions and lengths bound where
the window would lie, and its words are then compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .bytescan import LETTERS, LOWER, buffers, parts, shingle_hashes, spans, word_hashes
from .text import packed, unpacked

WIDTH = 3
_LEAST_BITS, _MOST_BITS = 16, 26  # the filter's size, as a power of two of bits: 8 KB to 8 MB
_PER_LIST = 64  # windows of one prefix that are compared from one row


def _windows(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """``item, window (words), hashes``: every window of every item with the hashes of its shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            starts, ends, first = spans(data, offsets, LETTERS)
            words, lower = word_hashes(data, starts, ends), LOWER[data]
            for i, item in enumerate(batch.column("item").to_pylist()):
                lo, hi = int(first[i]), int(first[i + 1])
                if lo == hi:
                    continue
                text = [bytes(lower[a:b]).decode() for a, b in zip(starts[lo:hi], ends[lo:hi])]
                m = min(size, hi - lo)
                width = min(WIDTH, m)
                h = shingle_hashes(words[lo:hi], width).view(np.int64)
                places = range(hi - lo - m + 1)
                yield pa.RecordBatch.from_pydict({
                    "item": [item] * len(places), "window": [text[a: a + m] for a in places],
                    "hashes": [h[a: a + m - width + 1] for a in places]},
                    pa.schema([("item", pa.string()), ("window", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64()))]))

    return (items.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").cast("binary").alias("text"))
            .mapInArrow(run, "item string, window array<string>, hashes array<long>"))


def _filter(hashes: DataFrame, n: int) -> np.ndarray:
    """A bitmap with the places of all ``hash`` set; what is gathered is at most its own 8 MB."""
    bits = int(np.clip(np.ceil(np.log2(max(1, n) * 256)), _LEAST_BITS, _MOST_BITS))
    words = (hashes.select(F.shiftrightunsigned("hash", 64 - bits).alias("place"))
             .selectExpr("place >> 6 AS at", "shiftleft(1L, CAST(place & 63 AS INT)) AS bit").groupBy("at").agg(F.bit_or("bit").alias("set")))
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    rows = words.toPandas()
    bitmap[rows["at"].to_numpy()] = rows["set"].to_numpy().view(np.uint64)
    return bitmap


def _hits(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Indexes of the hashes that the bitmap may hold."""
    place = h >> np.uint64(64 - int(np.log2(len(bitmap))) - 6)
    return np.flatnonzero((bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))


def _places(words: np.ndarray, first: np.ndarray, widths: list[int], bitmap: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each width, word index and hash of the shingles that pass the filter and lie in one text."""
    end = np.repeat(first[1:], np.diff(first))
    for width in widths:
        h = shingle_hashes(words, width)
        at = _hits(h, bitmap)
        at = at[at + width <= end[at]]
        yield at, h[at]


def _counted(docs: DataFrame, bitmap, widths: list[int]) -> DataFrame:
    """``hash, n``: how often documents hold the shingles that pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = []
            for part in parts(batch, "text"):
                data, offsets = buffers(part.column("text"))
                starts, ends, first = spans(data, offsets, LETTERS)
                seen += [h for _, h in _places(word_hashes(data, starts, ends), first, widths, bitmap.value)]
            found, n = np.unique(np.concatenate(seen) if seen else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["hash", "n"])

    return docs.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _probed(docs: DataFrame, bitmap, widths: list[int], size: int) -> DataFrame:
    """``id, of, n_words, found``: the places of possible prefixes, each with the words around it."""
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("around", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                data, offsets = buffers(part.column("text"))
                starts, ends, first = spans(data, offsets, LETTERS)
                n_words = np.diff(first)
                found: list[list[dict]] = [[] for _ in range(len(n_words))]
                for at, h in _places(word_hashes(data, starts, ends), first, widths, bitmap.value):
                    owner = np.searchsorted(first, at, "right") - 1
                    for p, doc, hash_ in zip(at.tolist(), owner.tolist(), h.view(np.int64).tolist()):
                        lo, hi = max(int(first[doc]), p - size), min(int(first[doc + 1]), p + size)
                        around = [bytes(LOWER[data[a:b]]).decode() for a, b in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist())]
                        found[doc].append({"hash": hash_, "at": p - int(first[doc]), "before": p - lo, "around": around})
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("of"), pa.array(n_words, pa.int64()), pa.array(found, kind)],
                    names=["id", "of", "n_words", "found"])

    return docs.mapInArrow(run, "id long, of long, n_words long, "
                           "found array<struct<hash:long,at:long,before:int,around:array<string>>>")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", size: int = 10) -> DataFrame:
    """One row ``id, of, n_words, spans, items`` for each row of ``docs``.

    Words are runs of digits, letters and everything beyond ASCII, A-Z in lower
    case.  A window is ``size`` consecutive words of an item; an item of fewer,
    but not none, is one window.  ``spans`` (start, length in words) are the
    places of windows in the document, ``items`` the ids, as sorted text, of the
    items whose windows occur.  Null texts have no words; null item ids are
    left out of ``items``; repeated rows are searched like any other; ``of`` is
    a hash of the text.  Only the named columns are read.

    Scale: documents are read twice, once to count and once to search; what
    leaves the readers are the shingles that pass a bitmap of at most 8 MB over
    the benchmark's shingles (false positives are weeded out by the joins).  The
    benchmark is joined, not broadcast.  Equal windows are one row, and a
    document's set of windows is resolved to items once per distinct set, so a
    passage that very many documents share costs no more than one.
    """
    spark = docs.sparkSession
    own = stage(_windows(items, item_id, item_text, size), "windows")
    window = own.select("window", "hashes").distinct()
    shingle = window.select("window", F.posexplode("hashes").alias("offset", "hash"))
    widths = [r[0] for r in own.select(F.least(F.size("window"), F.lit(WIDTH))).distinct().sort(F.desc(F.least(F.size("window"), F.lit(WIDTH)))).collect()]
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("of"),
                       F.col(f"`{text}`").cast("binary").alias("text"))

    def bitmap(of: DataFrame):
        hashes = of.select("hash").distinct()
        return spark.sparkContext.broadcast(_filter(hashes, hashes.count()))

    counts = stage(_counted(rows.select("text"), bitmap(shingle), widths) if widths
                   else spark.createDataFrame([], "hash long, n long"), "shingle-counts")
    # A window with a shingle that no document has cannot occur.
    rarest = (shingle.join(counts, "hash", "left").groupBy("window")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("p")).where("p.n > 0"))
    prefix = stage(rarest.select(F.col("p.hash").alias("hash"), F.struct(F.col("p.offset").alias("offset"), "window").alias("w")), "prefixes")
    nth = F.row_number().over(Window.partitionBy("hash").orderBy("w"))
    lists = stage(prefix.withColumn("part", F.floor((nth - 1) / _PER_LIST)).groupBy("hash", "part")
                  .agg(F.collect_list("w").alias("ws")).select("hash", "ws"), "prefix-lists")
    probed = stage(_probed(rows, bitmap(prefix), widths or [WIDTH], size).withColumn("rid", F.monotonically_increasing_id()), "probed")

    place = probed.select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    begins = lambda w: F.col("before") - w["offset"]
    fits = lambda w: (begins(w) >= 0) & (begins(w) + F.size(w["window"]) <= F.size("around"))
    same = lambda w: F.slice("around", begins(w) + 1, F.size(w["window"])) == w["window"]
    sure = (place.join(lists, "hash")
            .select("rid", F.transform(F.filter("ws", lambda w: F.when(fits(w), same(w)).otherwise(False)),
                                       lambda w: F.struct((F.col("at") - w["offset"]).cast("int").alias("start"), w["window"].alias("window"))).alias("hit"))
            .where(F.size("hit") > 0))
    by_doc = sure.groupBy("rid").agg(F.flatten(F.collect_list("hit")).alias("hit")).select(
        "rid", F.array_sort(F.array_distinct(F.transform("hit", lambda h: F.struct(h["start"].alias("start"), F.size(h["window"]).alias("length"))))).alias("spans"),
        F.array_sort(F.array_distinct(F.transform("hit", lambda h: h["window"]))).alias("windows"))
    by_doc = stage(by_doc.withColumn("k1", F.xxhash64("windows")).withColumn("k2", F.xxhash64(F.lit(1), "windows")), "hits")
    sets = by_doc.groupBy("k1", "k2").agg(F.first("windows").alias("windows"))
    named = (sets.select("k1", "k2", F.explode("windows").alias("window")).join(own.select("window", "item").distinct(), "window")
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items")))
    named = stage(named, "set-items")
    full = by_doc.join(named, ["k1", "k2"], "left").select("rid", "spans", "items")
    none = lambda kind: F.array().cast(kind)
    return probed.drop("found").join(full, "rid", "left").select(
        "id", "of", "n_words", F.coalesce("spans", none("array<struct<start:int,length:int>>")).alias("spans"),
        F.coalesce("items", none("array<string>")).alias("items"))


def n_covered(spans_: str = "spans"):
    """How many words lie in at least one span; ``spans`` is sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans_, zero,
        lambda acc, s: F.struct(F.greatest(acc["end"], s["start"] + s["length"]).alias("end"),
                                (acc["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(acc["end"], s["start"]))).alias("n")),
        lambda acc: acc["n"])


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", size: int = 10) -> DataFrame:
    """``docs`` without the rows in which a window of an item occurs."""
    found = contamination(docs, items, doc_id, text, item_id, item_text, size)
    dirty = stage(found.where(F.size("spans") > 0).select("id", "of").distinct(), "contaminated")
    rows = packed(docs, k=F.col(f"`{doc_id}`").cast("long"), h=F.xxhash64(F.col(f"`{text}`")))
    return unpacked(rows.join(dirty, (rows.h == dirty.of) & rows.k.eqNullSafe(dirty.id), "left_anti"), docs.columns)
