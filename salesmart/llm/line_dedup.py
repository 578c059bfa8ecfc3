"""Lines that several documents share stay in one of them only.

Every normalised line is exploded and hashed, documents are counted per hash,
lines over the threshold are dropped, and the rest is put together by position.
Native expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .text import ascii_lower, lines, packed, strip, unpacked

# A document without an id is taken as one with the largest id there is.
_NO_ID = 2**63 - 1


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10,
                min_docs: int = 2) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``.

    A line's key is the line stripped of white space at both ends, A-Z in lower
    case.  A key of at least ``min_chars`` code points found in at least
    ``min_docs`` documents loses all its lines except in the smallest document
    that has it; there, repeated lines stay too.

    A null or empty text is one empty line.  Rows with the same id are the same
    document, repeated rows keep the same lines.  A null id counts as one last
    document.  Input columns named like a result are replaced.

    Scale: only 16 bytes of hash, the id and the position of a line are
    shuffled.  Counting combines on the map side; a line that very many
    documents share is one row per task.  The shared keys, few beside all lines,
    are written to the shared folder, so that the join with the lines has a
    plain shuffle on both sides and a hot line can be split by AQE.  Texts are
    shuffled once, by document.
    """
    names = docs.columns
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = packed(docs, id=F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)), text=body)
    key = strip(F.col("line"))
    found = (
        rows.select("id", F.xxhash64("text").alias("of"), F.posexplode(lines(ascii_lower(F.col("text")))).alias("at", "line"))
        .select("id", "of", "at", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        # Two hashes from different seeds: 128 bits, as 64 would collide on a large corpus.
        .select("id", "of", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    if min_docs == 2:  # two documents: the smallest and the largest id differ
        shared = found.groupBy("h1", "h2").agg(F.min("id").alias("keeper"), F.max("id").alias("last")).where("keeper < last")
    else:
        shared = (found.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
                  .agg(F.min("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs))
    shared = stage(shared.select("h1", "h2", "keeper"), "shared-lines")
    dropped = (found.join(shared, ["h1", "h2"]).where(F.col("id") > F.col("keeper"))
               .groupBy("id", "of").agg(F.sort_array(F.collect_set("at")).alias("gone")))
    both = rows.withColumn("of", F.xxhash64("text")).join(dropped, ["id", "of"], "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    # The kept runs lie between the dropped positions; each slice copies its own length only.
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda p: p + 1))
    ends = F.concat(gone, F.array(F.size("all")))
    runs = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: F.slice("all", r["a"] + 1, r["b"] - r["a"]))
    kept = F.when(F.size(gone) == 0, F.col("text")).otherwise(F.array_join(F.flatten(runs), "\n"))
    return unpacked(both.withColumn("all", lines(F.col("text"))), names, n_lines=F.size("all").cast("long"),
                    n_dropped=F.size(gone).cast("long"), kept_text=kept)
