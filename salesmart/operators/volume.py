"""Volume test: replicate the fact and run the benchmark aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import stats


def replicate(df: DataFrame, k: int, name: str = "k") -> DataFrame:
    """Every row k times, numbered 1..k, generated in place: no join, no shuffle."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(k))))


def bench_agg(fact: DataFrame, dim: DataFrame, key: str, label: str, channel: str,
              net: str, units: str) -> DataFrame:
    """Net sales and units by dish and channel.

    The fact is summed per dish key first, so one row per (key, channel) meets
    the dimension however often a dish sells.
    """
    sums = fact.groupBy(key, channel).agg(F.sum(net).alias("ventas"), F.sum(units).alias("unidades"))
    named = sums.join(dim.select(key, label), key)
    return named.groupBy(label, channel).agg(F.sum("ventas").alias("ventas"), F.sum("unidades").alias("unidades"))


def timings_median(rows: DataFrame) -> DataFrame:
    """(tabla, filas, mediana_segundos) of (tabla, filas, corrida, microseg)."""
    sizes = rows.groupBy("tabla").agg(F.max("filas").alias("filas"))
    medians = stats.median_disc(rows, ["tabla"], "microseg", "m")
    return sizes.join(medians, "tabla").select(
        "tabla", "filas", F.round(F.col("m") / 1000000, 3).alias("mediana_segundos"))
