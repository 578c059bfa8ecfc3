"""Array predicates and updates for documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _literal(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def has(c: Column, value) -> Column:
    return F.array_contains(c, value)


def has_any(c: Column, values: Sequence) -> Column:
    return F.arrays_overlap(c, _literal(values))


def has_all(c: Column, values: Sequence) -> Column:
    return c.isNotNull() & (F.size(F.array_except(_literal(values), c)) == 0)


def push(c: Column, value) -> Column:
    """Append; a missing array starts empty."""
    return F.array_append(F.coalesce(c, F.array()), F.lit(value))
