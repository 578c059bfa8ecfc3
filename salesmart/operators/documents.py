"""Document-collection queries and updates over nested DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import arrays


def insert_docs(df: DataFrame, docs: DataFrame) -> DataFrame:
    """Add documents with other fields; fields one side lacks are NULL."""
    return df.unionByName(docs, allowMissingColumns=True)


def find(df: DataFrame, predicate: Column, order: Sequence[str] = (), n: int | None = None) -> DataFrame:
    """Matching documents, optionally the first n in an explicit order."""
    hits = df.filter(predicate)
    if order:
        hits = hits.orderBy(*order)
    return hits.limit(n) if n is not None else hits


def contains(df: DataFrame, column: str, value) -> Column:
    """Array holds the value, or a scalar equals it."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return arrays.has(F.col(column), value)
    return F.col(column) == value


def find_contains(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(contains(df, column, value))


def find_any(df: DataFrame, column: str, values: Sequence, columns: Sequence[str]) -> DataFrame:
    return df.filter(arrays.has_any(F.col(column), values)).select(*columns)


def find_unanswered(df: DataFrame, max_score: int) -> DataFrame:
    return df.filter((F.col("puntuacion") <= max_score) & F.col("respuesta_local").isNull())


def find_all_tags(df: DataFrame, tags: Sequence[str], column: str = "etiquetas") -> DataFrame:
    return df.filter(arrays.has_all(F.col(column), tags))


def find_nested(df: DataFrame, path: str, value) -> DataFrame:
    return df.filter(F.col(path) == value)


def count_docs(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _mean(column: str) -> Column:
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def rating_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(_mean("puntuacion").alias("promedio"), F.count(F.lit(1)).alias("resenas"))


def top_rated(df: DataFrame, key: str, min_n: int, k: int) -> DataFrame:
    """Best mean rating among groups with at least ``min_n`` documents; ties by key."""
    return rating_by(df, key).filter(F.col("resenas") >= min_n).orderBy(F.desc("promedio"), F.asc(key)).limit(k)


def by_source(df: DataFrame, key: str = "fuente") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), _mean("puntuacion").alias("prom")).orderBy(F.desc("n"), key)


def _changed(df: DataFrame, hit: Column, set_: Mapping[str, Column], push: Mapping[str, object]) -> DataFrame:
    new = {}
    for name, value in set_.items():
        old = F.col(name) if name in df.columns else F.lit(None)
        new[name] = F.when(hit, value).otherwise(old)
    for name, value in push.items():
        new[name] = F.when(hit, arrays.push(F.col(name), value)).otherwise(F.col(name))
    return df.withColumns(new)


def _flag_first(df: DataFrame, predicate: Column, key: str, order: Sequence[str]) -> DataFrame:
    """Mark the first match in an explicit order; ``key`` identifies documents.

    The first match is one row, so its join never shuffles the collection.
    """
    first = df.filter(predicate).orderBy(*order).limit(1).select(F.col(key).alias("_first"))
    return df.join(F.broadcast(first), F.col(key) == F.col("_first"), "left")


def update_one(df: DataFrame, predicate: Column, key: str, order: Sequence[str],
               set_: Mapping[str, Column] | None = None, push: Mapping[str, object] | None = None) -> DataFrame:
    marked = _flag_first(df, predicate, key, order)
    return _changed(marked, F.col("_first").isNotNull(), set_ or {}, push or {}).drop("_first")


def update_many(df: DataFrame, predicate: Column, set_: Mapping[str, Column]) -> DataFrame:
    """Set fields where the predicate holds; a field new to the collection stays NULL elsewhere."""
    return _changed(df, F.coalesce(predicate, F.lit(False)), set_, {})


def delete_where(df: DataFrame, predicate: Column, key: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Delete all matches, or with ``key`` and ``order`` only the first one."""
    if key is None:
        return df.filter(~F.coalesce(predicate, F.lit(False)))
    return _flag_first(df, predicate, key, order).filter("_first is null").drop("_first")


def tag_counts(df: DataFrame, column: str = "etiquetas", name: str = "etiqueta") -> DataFrame:
    """Occurrences per array element; documents without the array add nothing."""
    tags = df.select(F.explode(column).alias(name))
    return tags.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name)
