"""Two copies of a table compared by a tree of row hashes.

Rows are dealt into cells by their hash, and a cell is summed up by its number
of rows and two sums of independent hashes, whatever the order of rows.  Equal
copies are known by one small aggregate.  Where they differ, only the cells that
differ are opened, first into finer cells, then into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CELL_BITS = 12  # 4,096 cells, each of which opens into 4,096
_OTHER = 0x5EED


class CopiesDiffer(Exception):
    """Two copies hold different rows."""


def _hashed(df: DataFrame, columns: list[str], sign: int) -> DataFrame:
    # A NULL leaves a hash as it is, so each value comes with whether there is one.
    cells = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return df.select(*[F.col(f"`{c}`") for c in columns], F.lit(sign).alias("_sign"),
                     F.xxhash64(*cells).alias("_h"), F.xxhash64(F.lit(_OTHER), *cells).alias("_g"))


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    if sorted(a.columns) != sorted(b.columns):
        raise CopiesDiffer(f"columns {sorted(a.columns)} and {sorted(b.columns)}")
    return _hashed(a, a.columns, 1).unionByName(_hashed(b, a.columns, -1))


def _cell(level: int) -> Column:
    return F.shiftrightunsigned("_h", 64 - level * CELL_BITS)


def _sums(rows: DataFrame, level: int) -> DataFrame:
    signed = lambda c: F.sum(F.col("_sign").cast("decimal(20,0)") * F.col(c).cast("decimal(20,0)"))
    return rows.groupBy(_cell(level).alias("_cell")).agg(
        F.count_if(F.col("_sign") == 1).alias("_a"), F.count_if(F.col("_sign") == -1).alias("_b"), signed("_h").alias("_x"), signed("_g").alias("_y"))


def _differs() -> Column:
    return (F.col("_a") != F.col("_b")) | (F.col("_x") != 0) | (F.col("_y") != 0)


def compare_copies(a: DataFrame, b: DataFrame) -> DataFrame:
    """(filas_a, filas_b, filas_iguales, contenido_igual) of two copies, from one scan of each; at most 4,096 sums are shuffled a task."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return _sums(_both(a, b), 1).agg(total("_a").alias("filas_a"), total("_b").alias("filas_b"), F.count_if(_differs()).alias("_open")).select(
        "filas_a", "filas_b", (F.col("filas_a") == F.col("filas_b")).cast("int").alias("filas_iguales"),
        (F.col("_open") == 0).cast("int").alias("contenido_igual"))


def diff_copies(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows in which two copies differ: their columns, ``lado`` (a or b) and ``veces``, how many more times that side holds them.

    Repeated rows count, NULLs are equal to NULLs, columns go by name.  Empty
    when the copies hold the same rows.

    Scale: rows are hashed, not moved, until their cell is known to differ; with
    few differences a sixteen-millionth of the table for each is shuffled.  If
    all cells differ, this is one aggregate over all rows.
    """
    rows = _both(a, b)
    coarse = _sums(rows, 1).filter(_differs()).select("_cell")
    opened = rows.withColumn("_cell", _cell(1)).join(F.broadcast(coarse), "_cell", "left_semi").drop("_cell")  # at most 4,096 cells
    fine = _sums(opened, 2).filter(_differs()).select("_cell")
    suspects = opened.withColumn("_cell", _cell(2)).join(fine, "_cell", "left_semi")
    counted = suspects.groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.sum("_sign").alias("_n")).filter("_n <> 0")
    return counted.select(*[F.col(f"`{c}`") for c in a.columns], F.when(F.col("_n") > 0, "a").otherwise("b").alias("lado"),
                          F.abs("_n").cast("bigint").alias("veces"))


def require_same(a: DataFrame, b: DataFrame, name: str) -> None:
    """Stops with the first differing rows when ``b`` is not a copy of ``a``."""
    if compare_copies(a, b).first().contenido_igual:
        return
    rows = [row.asDict() for row in diff_copies(a, b).limit(5).collect()]
    raise CopiesDiffer(f"{name}: {rows}")
