"""A threshold table of text ratios, compiled into one projection.

No user function runs: measures and rules are built-in expressions over one
document, so the plan is a scan and a projection without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .text import WORD, lines, packed, strip, unpacked

# Common short words of the corpus' four languages.
STOP_WORDS = {
    "en": "the of and to in is that for with are on this be as by from at an it was",
    "fr": "le la les de des du un une et est que qui en dans pour par sur au pas ce",
    "de": "der die das und in den von zu mit ist ein eine nicht des dem auf für im als auch",
    "es": "el la los las de del y en que un una por con para se no es al lo su",
}

# measure, relation that must hold, bound.  A rule whose measure is null holds.
THRESHOLDS = [
    ("n_words", ">=", 50.0),
    ("mean_word_chars", ">=", 2.0),
    ("mean_word_chars", "<=", 12.0),
    ("symbols_per_word", "<=", 0.1),
    ("bangs_per_word", "<=", 0.2),
    ("stop_word_share", ">=", 0.05),
    ("dup_line_share", "<=", 0.5),
    ("repeat_word_share", "<=", 0.5),
]


def _fine(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _repeated(windows: Column) -> Column:
    """Words covered by the windows that occur at least twice.

    Windows are sorted with their places; those equal to a neighbour are marked,
    and the marked places, in order, cover up to three words each.
    """
    ordered = F.array_sort(F.arrays_zip(windows.alias("w"), F.sequence(F.lit(0), F.size(windows) - 1).alias("i")))

    def marked(all_: Column) -> Column:
        end = F.size(all_) - 1
        keep = F.filter(F.sequence(F.lit(0), end),
                        lambda k: F.when(k > 0, all_[F.greatest(k - 1, F.lit(0))]["w"] == all_[k]["w"]).otherwise(False)
                        | F.when(k < end, all_[F.least(k + 1, end)]["w"] == all_[k]["w"]).otherwise(False))
        return F.array_sort(F.transform(keep, lambda k: all_[k]["i"]))

    def covered(places: Column) -> Column:
        n = F.size(places)
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0),
                           lambda acc, k: acc + F.when(k == n - 1, 3).otherwise(F.least(F.lit(3), places[F.least(k + 1, n - 1)] - places[k])))

    # A lambda binds each array once, so that no step is evaluated per element again.
    def once(value: Column, then) -> Column:
        return F.transform(F.array(value), then)[0]

    return once(ordered, lambda o: once(marked(o), covered))


def measured(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``) and the base measures.

    Each array is a column of its own step, referred to more than once above it,
    so Catalyst keeps the steps apart and evaluates each array once.
    """
    body = _fine(F.col("text"))
    stop = sorted({w for s in STOP_WORDS.values() for w in s.split()})
    rows = rows.withColumns({
        "words": F.regexp_extract_all(body, F.lit(WORD), F.lit(0)),
        "inked": F.filter(lines(body), lambda line: F.char_length(strip(line)) > 0),
    })
    last = F.size("words") - 3
    # Windows are compared inside one document only, so 64 bits of hash tell them apart.
    window = lambda i: F.xxhash64(F.col("words")[i], F.col("words")[i + 1], F.col("words")[i + 2])
    rows = rows.withColumn("windows", F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), window))
                           .otherwise(F.array().cast("array<long>")))
    return rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("inked") - F.size(F.array_distinct("inked"))).cast("long"),
        # Texts without a repeated window skip the sort.
        "n_repeat_words": F.when(F.size(F.array_distinct("windows")) == F.size("windows"), 0)
        .otherwise(_repeated(F.col("windows"))).cast("long"),
        "n_inked_lines": F.size("inked").cast("long"),
        "n_bangs": F.regexp_count(body, F.lit("!")).cast("long"),
        "n_stop_words": F.size(F.filter("words", lambda w: F.lower(w).isin(*stop))).cast("long"),
    })


def ratios() -> dict[str, Column]:
    """Measures of the table over the columns of ``measured``; null where there is nothing to divide by."""
    per = lambda a, b: F.col(a).cast("double") / F.nullif(F.col(b).cast("double"), F.lit(0.0))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "bangs_per_word": per("n_bangs", "n_words"),
        "stop_word_share": per("n_stop_words", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_inked_lines"),
        "repeat_word_share": per("n_repeat_words", "n_words"),
    }


def compiled(table: list[tuple[str, str, float]]) -> Column:
    """The threshold table as one boolean expression."""
    holds = {">=": lambda c, b: c >= b, "<=": lambda c, b: c <= b}
    value = ratios()
    return reduce(lambda a, b: a & b, [F.coalesce(holds[op](value[name], F.lit(bound)), F.lit(True)) for name, op, bound in table])


def quality_rules(docs: DataFrame, text: str = "text", table: list[tuple[str, str, float]] | None = None) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated
    three-word windows.  ``kept``: not so, and every rule of ``table`` holds.
    A null or empty text has no words and fails.  Each row is judged alone, so
    repeated rows and null ids need no rule; input columns named like a result
    are replaced.
    """
    names = docs.columns
    rows = measured(packed(docs, text=F.col(f"`{text}`")))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", base)
    results = {c: F.col(c) for c in ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_inked_lines",
                                     "n_bangs", "n_stop_words", "base_failed"]}
    return unpacked(rows, names, **results, kept=~F.col("base_failed") & compiled(table or THRESHOLDS))
