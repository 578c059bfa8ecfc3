"""Native text expressions shared by the operators of this subpackage.

White space is the ASCII set ``[\\x20\\x09-\\x0D]`` everywhere; a word is a run of
anything else.  Lower-casing touches A-Z only, so it never changes a length.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z.  All-ASCII texts take the fast built-in; others go letter by letter."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def lines(c: Column) -> Column:
    """The pieces between line feeds; an empty text is one empty line."""
    return F.split(c, "\n", -1)


def n_words(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(WORD)).cast("long")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The columns of ``df`` as ``in_0``, ``in_1``, ... beside ``columns``, so no name of the input can clash.

    They stay columns of their own, so those nobody asks for are pruned before a shuffle.
    """
    return df.select(*[F.col(f"`{c}`").alias(f"in_{k}") for k, c in enumerate(df.columns)], *[v.alias(k) for k, v in columns.items()])


def unpacked(df: DataFrame, names: list[str], **results: Column) -> DataFrame:
    """The input's columns again, then ``results``; a result replaces an input column of its name."""
    taken = {k.lower() for k in results}
    return df.select(*[F.col(f"in_{k}").alias(c) for k, c in enumerate(names) if c.lower() not in taken],
                     *[v.alias(k) for k, v in results.items()])
