"""Joins.  No broadcast hints: Catalyst and AQE broadcast a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffle both sides, splitting skewed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import text


def join_header(lines: DataFrame, orders: DataFrame, key: str = "id_pedido") -> DataFrame:
    return lines.join(orders, key, "inner")


def attach(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keep every row of ``df``; add the columns of ``other`` where they exist."""
    return df.join(other, on, "left")


def unique_map(dim: DataFrame, key: str, value: str) -> DataFrame:
    """key -> value; the query fails when a key repeats."""
    checked = F.when(F.count(F.lit(1)) == 1, F.min(value)).otherwise(
        F.raise_error(F.concat(F.lit(f"repeated lookup key {key}="), F.first(key).cast("string"))))
    return dim.filter(F.col(key).isNotNull()).groupBy(key).agg(checked.alias(value))


def lookup(df: DataFrame, dim: DataFrame, on: str, key: str, value: str, check: bool = True) -> DataFrame:
    """Add ``value`` of the dimension row whose ``key`` equals ``df[on]``; unknown -> NULL.

    Never drops or multiplies rows.  ``check=False`` skips the repeat test for
    dimensions that are unique by construction.
    """
    mapping = unique_map(dim, key, value) if check else dim.select(key, value)
    mapping = mapping.withColumnRenamed(key, "_key")
    return df.join(mapping, F.col(on) == F.col("_key"), "left").drop("_key")


def lookup_normalised(df: DataFrame, dim: DataFrame, on: str, name: str, *values: str) -> DataFrame:
    """Match on the accent-, case- and spelling-insensitive form of a name.

    Adds ``<name>`` as stored in the dimension plus ``values``; unknown -> NULL.
    Two catalog names that normalise to the same text make the query fail.
    """
    catalog = dim.select(
        text.norm_name(F.col(name)).alias("_norm"),
        F.struct(F.col(name).alias("_name"), *[F.col(v) for v in values]).alias("_hit"),
    )
    matched = lookup(df.withColumn("_on", text.norm_name(F.col(on))), catalog, "_on", "_norm", "_hit")
    found = {f"{name}_norm" if name in df.columns else name: F.col("_hit._name")}
    found.update({v: F.col(f"_hit.{v}") for v in values})
    return matched.withColumns(found).drop("_on", "_hit")


def keep_accepted(lines: DataFrame, orders: DataFrame, key: str = "id_pedido") -> DataFrame:
    return lines.join(orders.select(key), key, "left_semi")


def find_orphans(lines: DataFrame, orders: DataFrame, key: str = "id_pedido") -> DataFrame:
    return lines.join(orders.select(key), key, "left_anti")


def missing_keys(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key is absent from the dimension (NULL keys included)."""
    return df.join(dim.select(F.col(key).alias("_key")), F.col(column) == F.col("_key"), "left_anti")


def diff_images(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """Old and new value of one column for rows present in both snapshots."""
    old = before.select(key, F.col(column).alias("antes"))
    new = after.select(key, F.col(column).alias("despues"))
    return old.join(new, key, "inner")


def sales_vs_rating(sales: DataFrame, docs: DataFrame) -> DataFrame:
    """Net sales per dish next to its mean rating; both sides are aggregated first."""
    sold = sales.groupBy("nombre_plato").agg(F.sum("importe_neto").alias("ventas"))
    rated = docs.groupBy("plato").agg(
        F.sum("puntuacion").alias("_puntos"), F.count(F.lit(1)).alias("n_resenas"))
    joined = sold.join(rated, sold.nombre_plato == rated.plato, "inner")
    return joined.select(
        "nombre_plato", "ventas",
        (F.col("_puntos").cast("double") / F.col("n_resenas")).alias("puntuacion_media"),
        "n_resenas")
