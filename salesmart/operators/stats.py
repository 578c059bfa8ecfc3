"""Descriptive statistics, exact percentiles, top-level counts."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage


def describe_cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max of each column, one row per column.

    All columns are aggregated in one pass and only the single result row is unpivoted.
    """
    stats = []
    for c in columns:
        v = F.col(c)
        mean = F.try_divide(F.sum(v).cast("double"), F.count(v))
        stats.append(F.struct(
            F.lit(c).alias("columna"), F.count(v).alias("n"), mean.alias("media"),
            F.stddev(v.cast("double")).alias("desviacion"),
            F.min(v).cast("double").alias("minimo"), F.max(v).cast("double").alias("maximo")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


RANKED_IN_ONE_TASK = 200_000  # distinct values of one interval that a task may put in order


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, points: Mapping[str, float],
                      most: int = RANKED_IN_ONE_TASK) -> DataFrame:
    """Exact discrete percentiles per group, without gathering a group in one task.

    Each round, a bounded sketch proposes cut values around every wanted rank,
    and exact counts per interval between cuts tell which interval holds it.
    Rounds go on inside these intervals until none has more than ``most``
    values; only then are the distinct values of an interval ranked.  A round that
    does not shrink an interval has met a value that most of its rows share, and
    cuts the other values to a twentieth; after three such rounds few are left,
    and equal values are counted before they are ranked.  A poor sketch costs
    rounds, never the right answer.

    The cuts and the wanted ranks (a few numbers per group) are staged, so the
    planner knows their real size and joins them without shuffling the rows when
    there are few groups.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    if not by:
        by, rows = ["_all"], rows.withColumn("_all", F.lit(0))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"))
    ranks = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.greatest(F.lit(1), F.ceil(F.col("_total") * F.lit(float(p)))).alias("rank"))
        for name, p in points.items()]))
    # One wanted rank per group and point, within the values above ``_low`` and up to ``_high`` (NULL: no bound).
    bound = rows.schema["_v"].dataType
    wanted = stage(
        sizes.withColumn("_w", ranks).select(
            *by, F.col("_w.name").alias("_name"), F.col("_w.rank").cast("long").alias("_rank"), F.col("_total").alias("_n"),
            F.lit(None).cast(bound).alias("_low"), F.lit(None).cast(bound).alias("_high"), F.lit(0).alias("_still")), "ranks")
    while not wanted.filter((F.col("_n") > most) & (F.col("_still") < 3)).isEmpty():
        wanted = _narrowed(rows, wanted, by)

    inside = _inside(rows, wanted.select(*by, "_low", "_high").distinct(), by)
    counted = inside.groupBy(*by, "_low", "_high", "_v").agg(F.count(F.lit(1)).alias("_c"))
    placed = counted.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by, "_low", "_high").orderBy("_v")))
    hits = placed.alias("p").join(wanted.alias("w"), _same("p", "w", [*by, "_low", "_high"])).filter(
        (F.col("w._rank") <= F.col("p._upto")) & (F.col("w._rank") > F.col("p._upto") - F.col("p._c")))
    picked = hits.groupBy(*[F.col(f"p.{c}").alias(c) for c in by]).agg(*[
        F.max(F.when(F.col("w._name") == name, F.col("p._v"))).alias(name) for name in points])
    return picked.drop("_all")


def _same(a: str, b: str, columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


def _inside(rows: DataFrame, intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the intervals of their group that hold them."""
    held = (F.coalesce(F.col("r._v") > F.col("i._low"), F.lit(True)) & F.coalesce(F.col("r._v") <= F.col("i._high"), F.lit(True)))
    return rows.alias("r").join(intervals.alias("i"), _same("r", "i", by)).filter(held).select("r.*", "i._low", "i._high")


def _narrowed(rows: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """The wanted ranks within narrower intervals."""
    keys = [*by, "_low", "_high"]
    inside = _inside(rows, wanted.select(*keys).distinct(), by)
    # Cuts lie three times the sketch's error around the wanted ranks.
    probes = [k / 20 for k in range(21)]
    shares = wanted.select("_rank", "_n").distinct().collect() if wanted.count() <= 64 else []
    for r in shares:
        probes += [min(1.0, max(0.0, r["_rank"] / r["_n"] + d)) for d in (-0.0003, 0.0003)]
    probes = sorted(set(probes))
    sketch = inside.groupBy(*keys).agg(F.percentile_approx("_v", [float(p) for p in probes], 10000).alias("_cuts"))
    cuts = stage(sketch, "cuts")
    at = F.size(F.filter("_cuts", lambda c: F.col("_v") > c))
    binned = inside.alias("x").join(cuts.alias("c"), _same("x", "c", keys)).select("x.*", "c._cuts").withColumn("_bin", at)
    counts = binned.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_c"), F.first("_cuts").alias("_cuts"))
    counts = counts.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*keys).orderBy("_bin")))
    found = counts.alias("k").join(wanted.alias("w"), _same("k", "w", keys)).filter(
        (F.col("w._rank") <= F.col("k._upto")) & (F.col("w._rank") > F.col("k._upto") - F.col("k._c")))
    low = F.when(F.col("k._bin") > 0, F.element_at("k._cuts", F.greatest(F.col("k._bin"), F.lit(1)))).otherwise(F.col("k._low"))
    high = F.when(F.col("k._bin") < F.size("k._cuts"), F.element_at("k._cuts", F.least(F.col("k._bin") + 1, F.size("k._cuts")))).otherwise(F.col("k._high"))
    return stage(found.select(
        *[F.col(f"k.{c}").alias(c) for c in by], F.col("w._name").alias("_name"),
        (F.col("w._rank") - (F.col("k._upto") - F.col("k._c"))).alias("_rank"), F.col("k._c").alias("_n"),
        low.alias("_low"), high.alias("_high"),
        F.when(F.col("k._c") > 0.7 * F.col("w._n"), F.col("w._still") + 1).otherwise(0).alias("_still")), "ranks")


def median_disc(df: DataFrame, by: Sequence[str], value: str, name: str = "mediana") -> DataFrame:
    return exact_percentiles(df, by, value, {name: 0.5})


def median_disc_over(df: DataFrame, by: Sequence[str], value: str, name: str = "mediana") -> DataFrame:
    """Windowed form followed by DISTINCT: the group's size next to its median."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("filas"))
    return sizes.join(median_disc(df, by, value, name), list(by), "left")


SKETCH_K = 4096  # size of a KLL sketch; its ranks are off by less than SKETCH_ERROR of the values with near certainty
SKETCH_ERROR = 0.002
_AROUND = (-SKETCH_ERROR, 0.0, SKETCH_ERROR)


@dataclass
class _Wanted:
    """One wanted rank of a column: the value lies above ``low`` and below ``high`` (None: no bound), or is ``found``."""

    column: str
    name: str
    rank: int  # among the values of the interval, from 1
    inside: int  # values of the interval
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def holds(self, v: Column) -> Column:
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (v > self.low)
        if self.high is not None:
            ok = ok & (v < self.high)
        return ok

    def narrow(self, probes: list[float], below: list[int], upto: list[int]) -> None:
        """Move to the part that holds the rank; ``below`` and ``upto`` count the interval's values < and <= each probe."""
        low, high, before, end = self.low, self.high, 0, self.inside
        for x, lt, le in zip(probes, below, upto):
            if lt < self.rank <= le:
                self.found = x
                return
            if le < self.rank:
                low, before = x, le
            elif lt >= self.rank:
                high, end = x, lt
                break
        self.low, self.high, self.inside, self.rank = low, high, end - before, self.rank - before


def exact_quantiles(df: DataFrame, columns: Sequence[str], points: Mapping[str, float], most: int = RANKED_IN_ONE_TASK) -> DataFrame:
    """(columna, one column per point): exact discrete percentiles of several columns, one row per column, as double.

    NULLs do not count, NaN is larger than any number, a column without values
    gives NULLs.  One aggregate over all columns makes a mergeable KLL sketch of
    each; the sketch proposes three values around every wanted rank, and one
    aggregate counts exactly how many values lie below and up to each of them.
    That leaves an interval of about a two-hundredth of the values, or the answer
    itself.  As long as an interval holds more than ``most`` values, it gets a
    sketch and a count of its own: a round takes out the proposed values with all
    their repetitions, so heavily repeated values end the search, they do not
    stall it.  Then the few values inside are put in order.  Rows are never
    multiplied or sorted, and a poor sketch costs rounds, never the right answer.
    """
    value = {c: F.col(c).cast("double") for c in columns}
    plain = {c: F.when(~F.isnan(v), v) for c, v in value.items()}
    # The first sketches are made in the scan that counts the values.
    n = df.agg(*[f for i, c in enumerate(columns) for f in (
        F.count(plain[c]).alias(f"n{i}"), F.count(value[c]).alias(f"all{i}"), F.kll_sketch_agg_double(plain[c], SKETCH_K).alias(f"s{i}"))])
    shares = sorted({min(1.0, max(0.0, p + d)) for p in points.values() for d in _AROUND})
    n = n.select("*", *[F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, shares)))).alias(f"q{i}")
                        for i in range(len(columns))]).drop(*[f"s{i}" for i in range(len(columns))]).first()
    answers: dict[tuple[str, str], float | None] = {}
    wanted: list[_Wanted] = []
    for i, c in enumerate(columns):
        for name, p in points.items():
            rank = max(1, math.ceil(n[f"all{i}"] * p))
            if not n[f"all{i}"] or rank > n[f"n{i}"]:
                answers[c, name] = float("nan") if n[f"all{i}"] else None
            else:
                wanted.append(_Wanted(c, name, rank, n[f"n{i}"]))
    proposed = {(c, None, None): n[f"q{i}"] for i, c in enumerate(columns)}
    while open_ := [w for w in wanted if w.found is None and w.inside > most]:
        _probe(df, plain, open_, proposed)
        proposed = {}
    open_ = [w for w in wanted if w.found is None]
    if open_:
        cells = F.array(*[F.when(w.holds(plain[w.column]) & plain[w.column].isNotNull(),
                                 F.struct(F.lit(k).alias("slot"), plain[w.column].alias("v"))) for k, w in enumerate(open_)])
        counted = df.select(F.inline(F.array_compact(cells))).groupBy("slot", "v").agg(F.count(F.lit(1)).alias("n"))
        placed = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("slot").orderBy("v")))
        rank = F.element_at(F.array(*[F.lit(w.rank) for w in open_]), F.col("slot") + 1)
        for row in placed.filter((rank <= F.col("upto")) & (rank > F.col("upto") - F.col("n"))).collect():  # one a wanted rank
            open_[row.slot].found = row.v
    answers |= {(w.column, w.name): w.found for w in wanted}
    schema = ", ".join(["columna string", *[f"{name} double" for name in points]])
    return df.sparkSession.createDataFrame([(c, *[answers[c, name] for name in points]) for c in columns], schema)


def _probe(df: DataFrame, plain: Mapping[str, Column], wanted: list[_Wanted], proposed: Mapping[tuple, list[float]]) -> None:
    """One round: values proposed by a sketch of every interval, where there are none yet, then exact counts around them."""
    groups: dict[tuple, list[_Wanted]] = {}
    for w in wanted:  # ranks in the same interval share its sketch and its values
        groups.setdefault((w.column, w.low, w.high), []).append(w)
    inside = {key: ws[0].holds(plain[key[0]]) for key, ws in groups.items()}
    proposed = dict(proposed)
    if missing := [key for key in groups if key not in proposed]:
        sketches = df.agg(*[F.kll_sketch_agg_double(F.when(inside[key], plain[key[0]]), SKETCH_K).alias(f"s{g}") for g, key in enumerate(missing)])
        shares = [sorted({min(1.0, max(0.0, w.rank / w.inside + d)) for w in groups[key] for d in _AROUND}) for key in missing]
        row = sketches.select(*[F.kll_sketch_get_quantile_double(f"s{g}", F.array(*map(F.lit, ps))).alias(f"q{g}") for g, ps in enumerate(shares)]).first()
        proposed |= {key: row[f"q{g}"] for g, key in enumerate(missing)}
    probes = {key: sorted(set(proposed[key])) for key in groups}
    counts = []
    for g, key in enumerate(groups):
        v = plain[key[0]]
        for k, x in enumerate(probes[key]):
            counts += [F.count_if(inside[key] & (v < x)).alias(f"lt{g}_{k}"), F.count_if(inside[key] & (v <= x)).alias(f"le{g}_{k}")]
    row = df.agg(*counts).first()
    for g, (key, ws) in enumerate(groups.items()):
        found = range(len(probes[key]))
        for w in ws:
            w.narrow(probes[key], [row[f"lt{g}_{k}"] for k in found], [row[f"le{g}_{k}"] for k in found])


def summary_cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """describe plus exact quartiles, one row per column."""
    quartiles = exact_quantiles(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return describe_cols(df, columns).join(quartiles, "columna", "left")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columna, nulos), counted in one pass."""
    cells = [F.struct(F.lit(c).alias("columna"), F.count_if(F.col(c).isNull()).alias("nulos")) for c in columns]
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def presence_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columna, presentes) of optional fields."""
    cells = [F.struct(F.lit(c).alias("columna"), F.count(F.col(c)).alias("presentes")) for c in columns]
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabla, filas) of many tables."""
    counts = [df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def avg_non_null(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    total, n = F.sum(column).cast("double"), F.count(column)
    return df.groupBy(*by).agg(F.try_divide(total, n).alias(name))


def sum_if(df: DataFrame, by: Sequence[str], condition: Column, column: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)).alias(name))


def joined_ids(df: DataFrame, column: str, width: int = 200) -> DataFrame:
    """Ids in ascending order joined by commas, cut to ``width`` characters; NULL ids are left out.

    Every id takes at least two characters with its comma, so ``width // 2 + 1``
    smallest ids already decide the text; only those reach the final task.
    """
    first = df.select(column).filter(F.col(column).isNotNull()).orderBy(column).limit(width // 2 + 1)
    ids = F.transform(F.array_sort(F.collect_list(column)), lambda x: x.cast("string"))
    return first.agg(F.left(F.array_join(ids, ","), F.lit(width)).alias("ids"))


def correlation(df: DataFrame, a: str, b: str, name: str = "r") -> DataFrame:
    return df.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(name))
