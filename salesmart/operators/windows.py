"""Window-style operators that stay distributed on skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in an explicit order.

    ``row_number() = 1`` plans as WindowGroupLimit: every map task keeps one row
    per key before the shuffle, so a hot key sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def discarded_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows ``dedupe_first`` drops, as one row ``descartados``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("descartados"))


def top_n_per_group(df: DataFrame, group: Sequence[str], measure: str, n: int,
                    tie: Sequence[str], rank: str = "rk") -> DataFrame:
    """The n rows with the largest measure in each group; ties go by ``tie``."""
    w = Window.partitionBy(*group).orderBy(F.desc(measure), *[F.asc(c) for c in tie])
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def top_k(df: DataFrame, measure: str, k: int, tie: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc(measure), *[F.asc(c) for c in tie]).limit(k)


def sort_by_ordinal(df: DataFrame, key: str) -> DataFrame:
    """Order by a numeric position (weekday number, month number), not by name."""
    return df.orderBy(F.asc(key))


def surrogate_key(df: DataFrame, order: Sequence[str], name: str, start: int = 1, parts: int | None = None) -> DataFrame:
    """Dense keys start, start+1, ... in a total order, without a single-task window.

    Rows are range-partitioned and sorted on the whole order, numbered inside
    each partition, and staged so the numbering is fixed; one small aggregate
    gives the row count per partition, whose running sum shifts the numbers.
    The order must be total, or equal rows are numbered arbitrarily.  ``parts``
    fixes the number of partitions; without it AQE joins small ones up to its
    advisory size, which many narrow rows outgrow once they are unpacked to be sorted.
    """
    columns = df.columns
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    numbered = (
        ranged
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    staged = stage(numbered, name).withColumns({
        "_part": F.shiftright("_id", 33),
        "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a partition: ``parts`` or spark.sql.shuffle.partitions bounds the window and the broadcast.
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    key = (F.col("_before") + F.col("_pos") + F.lit(start)).cast("bigint")
    return staged.join(F.broadcast(offsets), "_part").select(key.alias(name), *columns)


def share_within(df: DataFrame, measure: str, fixed: Sequence[str], name: str) -> DataFrame:
    """measure / total of the measure over rows that agree on ``fixed``.

    ``df`` is an aggregate, one row per reported group.  The grand total is a
    scalar subquery, so no task sees all rows.
    """
    if fixed:
        total = F.sum(measure).over(Window.partitionBy(*fixed))
    else:
        total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(name, F.try_divide(F.col(measure).cast("double"), total.cast("double")))


def yoy(df: DataFrame, grain: Sequence[str], measure: str) -> DataFrame:
    """Same period last year and growth of an aggregated measure.

    ``grain`` starts with ``anio`` (then quarter or month), or is ``['fecha']``.
    A self-join on the shifted key, so gaps give NULL instead of a wrong base.
    """
    if list(grain) == ["fecha"]:
        keys = {"fecha": F.add_months("fecha", -12)}
    else:
        keys = {c: F.col(c) - 1 if c == "anio" else F.col(c) for c in grain}
    base = df.select(*[F.col(c).alias(f"_b_{c}") for c in grain], F.col(measure).alias(f"{measure}_aa"))
    current = df.select("*", *[k.alias(f"_k_{c}") for c, k in keys.items()])
    on = None
    for c in grain:
        match = F.col(f"_k_{c}") == F.col(f"_b_{c}")
        on = match if on is None else on & match
    joined = current.join(base, on, "left")
    now, then = F.col(measure).cast("double"), F.col(f"{measure}_aa").cast("double")
    return joined.select(*df.columns, f"{measure}_aa", F.try_divide(now - then, then).alias("crecimiento"))
