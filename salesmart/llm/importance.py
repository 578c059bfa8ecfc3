"""Importance resampling towards a target collection, with n-gram hashes from prefix CRCs.

Every text is brought to its words with one blank between them and scanned
once; the CRC register before and after each word is kept.  CRC-32 is linear
over GF(2): the register after a prefix, moved over ``n`` zero bytes, cancels
out of the register ``n`` bytes later.  So two prefixes give the CRC of any run
of words, and no run is read again.  Runs are counted in buckets of their CRC;
the log ratio of target to corpus in a bucket is what a run is worth, and
documents are drawn by their mean worth plus Gumbel noise of their id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.windows import surrogate_key
from ..session import stage
from .bytescan import LETTERS, LOWER, spans, stretches

_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, least significant bit first
_ONES = np.uint32(0xFFFFFFFF)
_SPAN_BITS = 10
_SPAN = 1 << _SPAN_BITS  # bytes of one column of registers


def _byte_steps() -> np.ndarray:
    """The register after one byte, for each value of its low byte xor that byte."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> np.uint32(1)) ^ (np.uint32(_POLYNOMIAL) * (steps & np.uint32(1)))
    return steps


_STEP = _byte_steps()


def _stepped(c: np.ndarray) -> np.ndarray:
    """Registers moved over one zero byte."""
    return _STEP[c & np.uint32(255)] ^ (c >> np.uint32(8))


def _applied(table: np.ndarray, c: np.ndarray, row: np.ndarray | int = 0) -> np.ndarray:
    """A linear map of registers, given for each of their four bytes; ``row`` picks the map."""
    flat, at = table.reshape(-1), row * 1024
    out = flat[at + (c & np.uint32(255))]
    for byte in (1, 2, 3):
        out ^= flat[at + (256 * byte + ((c >> np.uint32(8 * byte)) & np.uint32(255)))]
    return out


class Shifts:
    """Moves of registers over zero bytes: 0 to 1,023 by one table, more by powers of two (4 MB in all)."""

    def __init__(self):
        maps = np.empty((_SPAN, 4, 256), np.uint32)
        now = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
        for k in range(_SPAN):
            maps[k] = now
            now = _stepped(now)
        self.maps = maps
        self.powers = [now]  # over 1,024, 2,048, ... bytes
        self.span = [row.tolist() for row in now]

    def __call__(self, c: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = _applied(self.maps, c, n & (_SPAN - 1))
        rest, k = n >> _SPAN_BITS, 0
        while rest.any():
            if k == len(self.powers):
                self.powers.append(_applied(self.powers[-1], self.powers[-1]))
            odd = np.flatnonzero(rest & 1)
            out[odd] = _applied(self.powers[k], out[odd])
            rest, k = rest >> 1, k + 1
        return out


_SHIFTS: list[Shifts] = []


def shifts() -> Shifts:
    if not _SHIFTS:
        _SHIFTS.append(Shifts())
    return _SHIFTS[0]


class PrefixCrcs:
    """CRC registers of all prefixes of ``text``, from one scan over 1,024-byte columns side by side."""

    def __init__(self, text: np.ndarray):
        n = len(text) // _SPAN + 1
        padded = np.zeros(n * _SPAN, np.uint8)
        padded[: len(text)] = text
        columns = np.ascontiguousarray(padded.reshape(n, _SPAN).T)
        self.shift = shifts()
        self.inside = np.empty((_SPAN, n), np.uint32)  # after so many bytes of each column, begun at zero
        c = np.zeros(n, np.uint32)
        for k in range(_SPAN):
            self.inside[k] = c
            c = _STEP[(c ^ columns[k]) & np.uint32(255)] ^ (c >> np.uint32(8))
        self.before = np.zeros(n, np.uint32)  # of all columns before
        b0, b1, b2, b3 = self.shift.span
        value = 0
        for k, own in enumerate(c[:-1].tolist(), 1):
            value = b0[value & 255] ^ b1[value >> 8 & 255] ^ b2[value >> 16 & 255] ^ b3[value >> 24] ^ own
            self.before[k] = value

    def __call__(self, at: np.ndarray) -> np.ndarray:
        column, place = at >> _SPAN_BITS, at & (_SPAN - 1)
        return self.shift(self.before[column], place) ^ self.inside[place, column]

    def between(self, at_start: np.ndarray, at_end: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes between two prefixes, from their registers alone."""
        return at_end ^ self.shift(at_start ^ _ONES, length) ^ _ONES


def feature_crcs(batch: pa.RecordBatch, column: str, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``rows, crcs, width``: the CRC-32 of each run of ``width`` words, 1 to ``most``, and the row it stands in.

    Texts are scanned in stretches of two megabytes; the register goes on from text to text, as it cancels out anyway.
    """
    for data, offsets, rows, old in stretches(batch, column, LETTERS, most - 1):
        starts, ends, first = spans(data, offsets, LETTERS)
        size = ends - starts
        if not len(size):
            continue
        stop = np.cumsum(size + 1)
        start = stop - size
        text, letter = np.full(int(stop[-1]), 32, np.uint8), np.ones(int(stop[-1]), bool)
        letter[start - 1] = False  # the blank in front of each word
        text[letter] = LOWER[data[LETTERS[data]]]
        prefixes = PrefixCrcs(text)
        at_start, at_end = prefixes(start), prefixes(stop)
        per_piece = np.diff(first)
        piece = np.repeat(np.arange(len(rows)), per_piece)
        nth = np.arange(len(start)) - np.repeat(first[:-1], per_piece)
        for width in range(1, most + 1):
            n = len(start) - width + 1
            if n <= 0:
                break
            good = (piece[:n] == piece[width - 1:]) & (nth[width - 1:] >= old[piece[width - 1:]])
            a = np.flatnonzero(good)
            b = a + (width - 1)
            yield rows[piece[a]], prefixes.between(at_start[a], at_end[b], stop[b] - start[a]), width


def _bucket_counts(texts: DataFrame, buckets: int, most: int) -> DataFrame:
    """``bucket, n``: features of all rows by bucket.  A task sends one row per bucket, whatever it reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crcs, _ in feature_crcs(batch, "text", most):
                counts += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int, most: int) -> np.ndarray:
    """What a feature of each bucket is worth: a thousand times the log ratio of its smoothed shares, rounded down.

    ``docs`` and ``target`` have a binary ``text``.  At most ``buckets`` rows of each reach the driver.
    """
    counts = []
    for table in (docs, target):
        found = np.zeros(buckets, np.int64)
        rows = _bucket_counts(table, buckets, most).toPandas()
        found[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
        counts.append(found)
    own, wanted = (int(c.sum()) for c in counts)
    return np.array([math.floor(1000 * math.log(((t + 1) * (own + buckets)) / ((s + 1) * (wanted + buckets))))
                     for s, t in zip(counts[0].tolist(), counts[1].tolist())], np.int64)


def importance(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", *,
               buckets: int = 10_000, most_words: int = 2, least_words: int = 20, percent: int = 25, seed: int = 7) -> DataFrame:
    """One row ``id, of, n_words, n_features, weight, score, rank`` for each row of ``docs``; ``of`` is a hash of its text.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z
    in lower case; features are all runs of 1 to ``most_words`` of them, repeats
    counted.  ``weight`` is the mean gain of the features' buckets, rounded down;
    ``score`` adds Gumbel noise of ``seed:id``.  Of the rows with at least
    ``least_words`` words, ``percent`` of a hundred (rounded down) with the
    highest scores are drawn and numbered by ``rank``; others have a null rank.

    Null and empty texts have no feature, weight 0 and are never drawn.  A null
    id has the noise of an empty id and comes last among equal scores.  Equal
    scores go by id, then by number of features; rows alike in all these are
    numbered in any order.  Repeated rows are rows of their own.  Without any
    target text every feature is worth what smoothing leaves.  Empty ``docs``
    give no row.  Only the named columns are read, so others cannot clash.

    Scale: documents are read twice, once for the bucket counts of all of them,
    once to be weighed; texts are never shuffled.  A task sends at most
    ``buckets`` counts, so neither a hot source nor copies make a hot key.  The
    ranking is by ranges of score and id, never one window.
    """
    body = F.col(f"`{text}`")
    gains = bucket_gains(docs.select(body.cast("binary").alias("text")), target.select(F.col(f"`{target_text}`").cast("binary").alias("text")),
                         buckets, most_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, sums = (np.zeros(n, np.int64) for _ in range(3))
            for rows, crcs, width in feature_crcs(batch, "text", most_words):
                here = np.bincount(rows, minlength=n)
                features += here
                words += here if width == 1 else 0
                sums += np.bincount(rows, gains[crcs % np.uint32(buckets)], n).astype(np.int64)
            weight = sums // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("of"), pa.array(words), pa.array(features), pa.array(weight)],
                                             names=["id", "of", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(body).alias("of"), body.cast("binary").alias("text"))
    weighed = stage(rows.mapInArrow(run, "id long, of long, n_words long, n_features long, weight long"), "importance")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = weighed.withColumn("score", F.col("weight") + noise)
    fit = F.col("n_words") >= least_words
    drawn = percent * weighed.where(fit).count() // 100
    ordered = scored.where(fit).select("*", (-F.col("score")).alias("down"), F.col("id").isNull().alias("no_id"))
    ranked = surrogate_key(ordered, ["down", "no_id", "id", "n_features"], "rank").drop("down", "no_id")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``importance`` draws, with all their columns.

    A row with the id and text of a drawn one is drawn with it, so repeated rows stay together.
    """
    chosen = importance(docs, target, doc_id, text, target_text, **options).where("rank IS NOT NULL")
    chosen = stage(chosen.select(F.col("id").alias("_drawn_id"), F.col("of").alias("_drawn_of")).distinct(), "drawn")
    same = (F.xxhash64(F.col(f"`{text}`")) == F.col("_drawn_of")) & F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col("_drawn_id"))
    return docs.join(chosen, same, "left_semi")
