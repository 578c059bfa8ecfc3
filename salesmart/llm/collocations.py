"""Collocations: phrases whose words stand together more often than alone, mined by partitioning.

The corpus is dealt into shards.  A phrase found ``least`` times in all is found
at least its share of that, ``least / shards`` times, in some shard; so every
shard is mined completely at that lowered support, the phrases frequent in any
shard are the candidates, and a last scan counts all candidates exactly.

Mining works on 64-bit hashes, where a collision can only add a candidate.  A
phrase of ``w`` words is looked for only where both its parts of ``w - 1`` words
are candidates.  The last scan counts words themselves, never hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .bytescan import LOWER, mixed, shingle_hashes, spans, stretches, word_hashes

#: Bytes that end a piece: no phrase goes over them.  Blanks and tabs part words inside a piece.
BREAKS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
WORDS = ~(BREAKS | np.isin(np.arange(256), list(b" \t")))

NO_LANG = "und"
MAX_SHARDS = 8
_SHARD_BITS = 3
_STRETCH = 1 << 21  # bytes scanned at once
_HELD = 1 << 21  # hashes a task counts before it sends them on
_LEAST_BITS, _MOST_BITS = 16, 28  # the candidate filter: 8 KB to 32 MB
_PLACE_BITS = 15  # places of one built-in bitmap


@dataclass
class _Stretch:
    """The words of a stretch of texts: where they are, and which of them belong together."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray  # row in the batch, by word
    piece: np.ndarray  # words of the same piece of the same text have the same number
    fresh: np.ndarray  # not seen in the stretch before

    def runs(self, width: int) -> np.ndarray:
        """First words of the runs of ``width`` words inside a piece that no stretch before held."""
        n = len(self.starts) - width + 1
        if n <= 0:
            return np.empty(0, np.int64)
        return np.flatnonzero((self.piece[:n] == self.piece[width - 1:]) & self.fresh[width - 1:])


def _stretches(batch: pa.RecordBatch, overlap: int) -> Iterator[_Stretch]:
    for data, offsets, rows, old in stretches(batch, "text", WORDS, overlap, _STRETCH):
        starts, ends, first = spans(data, offsets, WORDS)
        if not len(starts):
            continue
        per_text = np.diff(first)
        text = np.repeat(np.arange(len(rows)), per_text)
        nth = np.arange(len(starts)) - np.repeat(first[:-1], per_text)
        breaks = np.cumsum(BREAKS[data], dtype=np.int32)[starts]
        yield _Stretch(data, starts, ends, rows[text], breaks + text, nth >= old[text])


def _hashes(s: _Stretch, langs: np.ndarray) -> np.ndarray:
    """A hash of each word and its language."""
    return mixed(word_hashes(s.data, s.starts, s.ends) ^ langs[s.row])


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(v) for v in coded.dictionary.to_pylist()], np.uint64)
    return known[coded.indices.to_numpy(zero_copy_only=False)]


def _may_hold(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> np.uint64(64 - (int(len(bitmap)).bit_length() - 1) - 3)
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A filter with a place for each ``hash``, 16 places a candidate while it has 32 MB or less; what it lets pass is counted exactly."""
    n = hashes.count()
    bits = min(_MOST_BITS, max(_LEAST_BITS, math.ceil(math.log2(max(1, 16 * n)))))
    place = F.shiftrightunsigned("hash", 64 - bits)
    rows = (hashes.select(F.shiftright(place, _PLACE_BITS).alias("part"), place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("place"))
            .groupBy("part").agg(F.bitmap_construct_agg("place").alias("set")))
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (_PLACE_BITS - 3)
    for r in rows.toLocalIterator():  # at most 8,192 bitmaps of 4 KB
        out[r.part * size: (r.part + 1) * size] = np.frombuffer(r.set, np.uint8)
    return out


def _mined(texts: DataFrame, widths: list[int], most: int, support: int, shards: int, bitmap=None) -> DataFrame:
    """``hash`` of every phrase of ``widths`` words that some shard holds ``support`` times; a superset by collisions only.

    A task's rows are one shard's.  ``bitmap`` holds the phrases one word shorter that are candidates.
    """
    low = np.uint64((1 << _SHARD_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = np.uint64(TaskContext.get().partitionId() % shards)
        held, n = [], 0

        def counted() -> pa.RecordBatch:
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], names=["key", "n"])

        for batch in batches:
            langs = _lang_hashes(batch.column("lang"))
            for s in _stretches(batch, most - 1):
                words = _hashes(s, langs)
                for width in widths:
                    at = s.runs(width)
                    if bitmap is not None:
                        known = _may_hold(bitmap.value, shingle_hashes(words, width - 1))
                        at = at[known[at] & known[at + 1]]
                    held.append((shingle_hashes(words, width)[at] & ~low) | shard)
                    n += len(at)
                if n >= _HELD:
                    yield counted()
                    held, n = [], 0
        if n:
            yield counted()

    # Dealt by key first: a task's counts are summed already, a second sum before the shuffle would find little.
    counts = texts.mapInArrow(run, "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
    kept = counts.where(F.col("n") >= support).select(F.col("key").bitwiseAND(F.lit(~int(low))).alias("hash"))
    return kept.distinct()


def _counted(texts: DataFrame, most: int, bitmaps: list) -> DataFrame:
    """``lang, phrase, n``: exact counts of what passes the filter of its length; a null phrase counts a language's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            lang_of_row = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            langs = _lang_hashes(batch.column("lang"))
            for s in _stretches(batch, most - 1):
                lang = lang_of_row[s.row]
                totals = np.bincount(lang[s.fresh], minlength=len(coded.dictionary))
                yield _rows(coded.dictionary, np.arange(len(totals)), pa.nulls(len(totals), pa.binary()), totals)
                inside = WORDS[s.data]
                offsets = np.concatenate([[0], np.cumsum(s.ends - s.starts)])
                words = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(s.starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(LOWER[s.data[inside]])])
                coded_words = words.dictionary_encode()
                one = lang * len(coded_words.dictionary) + coded_words.indices.to_numpy(zero_copy_only=False)
                _, one = np.unique(one, return_inverse=True)  # a number for each word of each language
                size = int(one.max()) + 1
                hashes = _hashes(s, langs)
                for width in range(1, most + 1):
                    at = s.runs(width)
                    if not len(at):
                        continue
                    at = at[_may_hold(bitmaps[width - 1].value, shingle_hashes(hashes, width)[at])]
                    key = one[at]
                    for k in range(1, width):
                        _, key = np.unique(key, return_inverse=True)
                        key = key * size + one[at + k]
                    _, first, n = np.unique(key, return_index=True, return_counts=True)
                    at = at[first]
                    for lo in range(0, len(at), 1 << 17):
                        some = at[lo: lo + (1 << 17)]
                        parts = [words.take(pa.array(some + k)) for k in range(width)]
                        phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if width > 1 else parts[0]
                        yield _rows(coded.dictionary, lang[some], phrase, n[lo: lo + (1 << 17)])

    counts = texts.mapInArrow(run, "lang string, phrase binary, n long")
    return counts.select("lang", F.col("phrase").cast("string").alias("phrase"), "n").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _rows(langs: pa.Array, lang: np.ndarray, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs.take(pa.array(lang)).cast(pa.string()), phrase.cast(pa.binary()), pa.array(n.astype(np.int64))],
                                      names=["lang", "phrase", "n"])


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", *, most: int = 3, least: int = 10, shards: int = 4) -> DataFrame:
    """``lang, phrase, n``: phrases of 1 to ``most`` words found ``least`` times or more, and each language's words under a null phrase."""
    if not 1 <= shards <= MAX_SHARDS or most < 2:
        raise ValueError(f"shards must be 1 to {MAX_SHARDS}, most 2 or more")
    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").cast("binary").alias("text"))
    context = docs.sparkSession.sparkContext
    support = -(-least // shards)
    bitmaps = []
    for width in range(1, most + 1):
        widths = [1, 2] if width == 1 else [width]
        if width != 2:  # words and pairs share one scan, as nearly every word is in some pair
            found = stage(_mined(texts, widths, most, support, shards, bitmaps[-1] if width > 2 else None), f"phrases-{width}")
            bitmaps.append(context.broadcast(_bitmap(found)))
        else:
            bitmaps.append(bitmaps[0])
    counts = _counted(texts, most, bitmaps)
    return stage(counts.where((F.col("n") >= least) | F.col("phrase").isNull()), "phrase-counts")


def _joined(words: Column, lo: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, lo, n), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", *, most: int = 3, least: int = 10, shards: int = 4,
                 covered: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``most`` words of each language.

    A-Z is lowered; texts are split at ``.,;:!?`` and line ends into pieces, and
    those at blanks and tabs into words.  ``a`` is how often the phrase stands in
    a piece, overlaps included.  Cut after its first words, ``l`` and ``r`` count
    its parts and ``1000000 * a * a / (l * r)``, rounded down, is the score; the
    cut that scores lowest counts, the earliest of equals.  Phrases with ``a``
    below ``least`` are left out, then those inside a longer one found at least
    ``covered`` times for each hundred of theirs.  ``n`` counts the language's words.

    Null texts are empty, a null language is ``und``, together with any so named.
    Repeated rows count again.  Equal scores go by ``a``, then by phrase, so
    ranks are unique.  An empty table gives no row.  Other columns are not read.

    Scale: three scans of the texts, none of them shuffled.  Mining shuffles
    hashes with counts, summed in the task; the last scan shuffles only phrases
    that pass a filter of 32 MB at most.  A task holds 2 million hashes and 2 MB
    of text at a time.  A very frequent phrase is one row a task.  Ranks are
    found in groups of a language's phrases first, so no task sorts them all.
    """
    counts = phrase_counts(docs, text, lang, most=most, least=least, shards=shards)
    words = F.split("phrase", " ")
    found = counts.where("phrase IS NOT NULL").withColumn("k", F.size(words))
    phrases = found.where("k > 1").withColumnRenamed("n", "a")

    cuts = phrases.select("lang", "phrase", "a", "k", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _joined(F.col("w"), F.lit(1), F.col("cut")).alias("left"),
                       _joined(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    part = lambda side, name: found.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    exact = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    cuts = cuts.withColumn("score", F.expr(f"{exact('a')} * {exact('a')} * 1000000 DIV ({exact('l')} * {exact('r')})"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    inner = phrases.where("k > 2").select("lang", "a", words.alias("w"), "k")
    inner = inner.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("lo"))
    longer = inner.groupBy("lang", _joined(F.col("w"), F.col("lo"), F.col("size")).alias("phrase")).agg(F.max("a").alias("around"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("around") < covered * F.col("a"), F.lit(True)))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score", F.xxhash64("phrase").alias("h"))
    for groups in (4096, 64, 1):
        place = Window.partitionBy("lang", F.pmod(F.col("h"), F.lit(groups))).orderBy(*order)
        ranked = ranked.withColumn("rank", F.row_number().over(place).cast("long")).where(F.col("rank") <= top)
    total = counts.where("phrase IS NULL").select("lang", "n")
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
