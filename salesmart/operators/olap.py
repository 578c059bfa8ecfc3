"""Roll-up, cube, grouping sets, slice, dice, pivot, drill-down.

Additive measures are first summed at the leaf grain; subtotals are then built
from the leaf rows, so the row expansion of ROLLUP/CUBE runs on the small
aggregate instead of the fact table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

# Ordered drill paths.
HIERARCHIES = {
    "fecha": ["anio", "trimestre", "anio_mes", "fecha"],
    "plato": ["categoria", "nombre_plato"],
}

TOTAL = "Total"


def sum_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """``sums`` maps result name -> column."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in sums.items()])


def _again(sums: Mapping[str, str]) -> list:
    return [F.sum(name).alias(name) for name in sums]


def _flags(keys: Sequence[str]) -> list:
    return [F.grouping(k).alias(f"g_{k}") for k in keys]


def rollup_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    leaf = sum_by(df, keys, sums)
    return leaf.rollup(*keys).agg(*_again(sums), *_flags(keys))


def cube_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    leaf = sum_by(df, keys, sums)
    return leaf.cube(*keys).agg(*_again(sums), *_flags(keys))


def grouping_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]],
                  sums: Mapping[str, str]) -> DataFrame:
    leaf = sum_by(df, keys, sums)
    chosen = [[F.col(c) for c in s] for s in sets]
    return leaf.groupingSets(chosen, *keys).agg(*_again(sums), *_flags(keys))


def rollup_levels(df: DataFrame, path: Sequence[str], sums: Mapping[str, str]) -> dict[str, DataFrame]:
    """One result per level, finest first; each level sums the one below."""
    results, current = {}, df
    for depth in range(len(path), 0, -1):
        keys = list(path[:depth])
        current = sum_by(current, keys, sums)
        results[keys[-1]] = current
        sums = {name: name for name in sums}
    return results


def drill_down(df: DataFrame, path: Sequence[str], fixed: Mapping[str, object],
               sums: Mapping[str, str]) -> DataFrame:
    """Children of the members in ``fixed``; with nothing fixed, the top level."""
    for column, member in fixed.items():
        df = df.filter(F.col(column) == member)
    return sum_by(df, [path[len(fixed)]], sums)


def slice_(df: DataFrame, column: str, member) -> DataFrame:
    return df.filter(F.col(column) == member)


def in_quarter(df: DataFrame, year: int, quarter: int) -> DataFrame:
    """Rows of one quarter; where the rows carry ``fecha``, a date range reaches the scan."""
    kept = df.filter((F.col("anio") == year) & (F.col("trimestre") == quarter))
    if "fecha" not in df.columns:
        return kept
    first = dt.date(year, 3 * quarter - 2, 1)
    after = dt.date(year + quarter // 4, 3 * quarter % 12 + 1, 1)
    return kept.filter((F.col("fecha") >= F.lit(first)) & (F.col("fecha") < F.lit(after)))


def dice(df: DataFrame, year: int, quarter: int, categories: Sequence[str], payments: Sequence[str]) -> DataFrame:
    """Rows of one quarter, some categories and some payments."""
    return in_quarter(df.filter(F.col("categoria").isin(*categories) & F.col("metodo_pago").isin(*payments)), year, quarter)


def pivot_sums(df: DataFrame, row: str | Sequence[str], column: str, values: Sequence[str], measure: str) -> DataFrame:
    """Sum of ``measure``; result columns are ``values`` in that order."""
    rows = [row] if isinstance(row, str) else list(row)
    leaf = df.filter(F.col(column).isin(*values)).groupBy(*rows, column).agg(F.sum(measure).alias("_m"))
    return leaf.groupBy(*rows).pivot(column, list(values)).agg(F.first("_m"))


def pivot_margins(df: DataFrame, row: str, column: str, values: Sequence[str], measure: str) -> DataFrame:
    """Pivot with a Total row and a Total column, rounded to two digits.

    ``values`` names the columns to show; totals count every member, shown or
    not, without rows whose row or column member is NULL.  They are told from
    members by ``grouping()``, never by NULL.
    """
    kept = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    cells = cube_sums(kept, [row, column], {"_m": measure})
    labelled = cells.select(
        F.when(F.col(f"g_{row}") == 1, TOTAL).otherwise(F.col(row)).alias(row),
        F.when(F.col(f"g_{column}") == 1, TOTAL).otherwise(F.col(column)).alias(column),
        F.round("_m", 2).alias("_m"))
    return labelled.groupBy(row).pivot(column, [*values, TOTAL]).agg(F.first("_m"))
