"""Pseudonyms and masks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def hash_id(c: Column, salt: str) -> Column:
    """Salted SHA-256 in upper-case hex; NULL stays NULL."""
    return F.upper(F.sha2(F.concat(F.lit(salt), c.cast("string")), 256))


def mask_email(c: Column) -> Column:
    """First letter kept, the rest fixed."""
    return F.concat(F.left(c, F.lit(1)), F.lit("XXX@XXXX.com"))


def mask_partial(c: Column, prefix: int, padding: str, suffix: int) -> Column:
    """Keep ``prefix`` leading and ``suffix`` trailing characters."""
    return F.concat(F.left(c, F.lit(prefix)), F.lit(padding), F.right(c, F.lit(suffix)))


def mask_default(c: Column, dtype: T.DataType) -> Column:
    """0 for numbers, xxxx for text; NULL stays NULL."""
    fixed = F.lit(0).cast(dtype) if isinstance(dtype, T.NumericType) else F.lit("xxxx")
    return F.when(c.isNotNull(), fixed)
