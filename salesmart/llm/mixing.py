"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are summed by the set of sources they belong to (their membership
pattern).  Word capacity flows from patterns to the sources' quotas; using a
pattern's words once is free, every repetition costs more than the one before.
Documents are then taken by a seeded hash until each pattern's flow is used up.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .text import n_words

_NOWHERE = object()  # None is a source
CELL_BITS = 12
MAX_PATTERNS = 100_000


def capped_targets(sizes: dict[str | None, int], weights: dict[str | None, float], most: float, words: int) -> dict[str | None, float]:
    """Shares of ``words`` by weight, none above ``most`` times its own size.

    What a capped source cannot take is shared among the others by weight again,
    until none is above.  Sources without words get nothing.
    """
    targets, open_, left = dict.fromkeys(sizes, 0.0), [s for s in sizes if sizes[s] > 0], float(words)
    while open_ and left > 0:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total > most * sizes[s]]
        if not over:
            targets.update({s: left * weights[s] / total for s in open_})
            break
        for s in over:
            targets[s] = float(most * sizes[s])
        left -= sum(targets[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return targets


def cheapest_flow(patterns: dict[tuple, int], quotas: dict, copies: int) -> dict[tuple, dict]:
    """Words that each pattern sends to each of its sources.

    Costs lie on a pattern's use only: 0 for its words once, 1 for the second
    time, 2 for the third, and so on.  The cheapest path that still reaches an
    open quota therefore starts with the lowest level that has one, so the
    levels are opened in turn and each is filled by augmenting paths.
    """
    flow: dict[tuple, dict] = {p: dict.fromkeys(p, 0.0) for p in patterns}
    room = {s: float(q) for s, q in quotas.items()}
    members: dict = {}
    for p in patterns:
        for s in p:
            members.setdefault(s, []).append(p)
    least = 1e-6
    for _ in range(copies):
        spare = {p: float(c) for p, c in patterns.items()}
        for p in patterns:
            while spare[p] > least:
                # Breadth first over sources; flow that another pattern sends to a full source can move on.
                came: dict = {s: (p, _NOWHERE) for s in p}
                queue, end = deque(p), _NOWHERE
                while queue:
                    s = queue.popleft()
                    if room.get(s, 0.0) > least:
                        end = s
                        break
                    for other in members[s]:
                        if flow[other][s] > least:
                            for t in other:
                                if t not in came:
                                    came[t] = (other, s)
                                    queue.append(t)
                if end is _NOWHERE:
                    break
                amount, s = min(spare[p], room[end]), end
                while came[s][1] is not _NOWHERE:
                    amount, s = min(amount, flow[came[s][0]][came[s][1]]), came[s][1]
                s = end
                while True:
                    other, back = came[s]
                    flow[other][s] += amount
                    if back is _NOWHERE:
                        break
                    flow[other][back] -= amount
                    s = back
                spare[p] -= amount
                room[end] -= amount
    return flow


def mix(docs: DataFrame, size, sources, weights: Callable[[list], dict], doc_id: str = "doc_id", most: int = 3,
        seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs``, and what each pattern sends where.

    ``size`` is a column of whole numbers, ``sources`` an array column of the
    sources a row belongs to (a null element is a source of its own; an empty or
    null array belongs to none and is never taken).  ``weights`` maps the sorted
    list of sources, null last, to their weights.  The sum of all sizes is shared
    out by ``capped_targets``.

    First result: one row per input row, with ``row`` (the input as a struct),
    ``size``, ``pattern`` (its sources, each with an s before it, n for null) and
    ``copies`` (0 to ``most``).  Second: ``pattern``, ``source``, ``words``,
    ``source_size``, ``target``.

    Every row of a pattern is taken as often as the flow covers the pattern in
    full; the rest goes once more to rows in the order of a seeded hash of id and
    size, until it is used up to the nearest row.  Equal rows have equal hashes;
    null ids hash like any value.  Rows of size 0 go with the full copies.

    Scale: sums combine on the map side.  Only sums per pattern reach the driver
    (the caller states a weight for each source there anyway); more than
    ``MAX_PATTERNS`` of them are refused, never cut.  The place in the hash order
    is found by sums over hash cells, narrowed twice, so a source with a third of
    all rows is never sorted or gathered.
    """
    # Arrays with nulls are never equal in a join, so sources are marked: n for null, else s and the name.
    marked = F.transform(F.coalesce(sources.cast("array<string>"), F.array().cast("array<string>")),
                         lambda s: F.coalesce(F.concat(F.lit("s"), s), F.lit("n")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
        F.array_sort(F.array_distinct(marked)).alias("pattern"), F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), size).alias("h"))
    rows = stage(rows, "mix-rows")
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sets of sources; mix groups of sources")
    patterns = {tuple(None if s == "n" else s[1:] for s in r["pattern"]): int(r["size"]) for r in sums if r["pattern"]}
    total: dict = {}
    for p, n in patterns.items():
        for s in p:
            total[s] = total.get(s, 0) + n
    ordered = sorted(total, key=lambda s: (s is None, s or ""))  # by code point, null last
    # A document in several sources counts once in what is shared out.
    quotas = capped_targets(total, weights(ordered), most, sum(patterns.values()))
    patterns = {p: patterns[p] for p in sorted(patterns, key=lambda p: tuple((s is None, s or "") for s in p))}
    flow = cheapest_flow(patterns, quotas, most)

    spark = docs.sparkSession
    mark = lambda p: sorted("n" if s is None else "s" + s for s in p)
    plan = []
    for p, n in patterns.items():
        used = sum(flow[p].values())
        full = min(most, int((used + 1e-3) // n)) if n else 0
        plan.append((mark(p), full, max(0.0, used - full * n) if full < most else 0.0))
    plan_df = F.broadcast(spark.createDataFrame(plan, "pattern array<string>, full int, rest double"))  # at most MAX_PATTERNS rows
    routes = spark.createDataFrame([(mark(p), s, w, total[s], quotas[s]) for p in patterns for s, w in flow[p].items()],
                                   "pattern array<string>, source string, words double, source_size long, target double")

    cell = lambda k: F.expr(f"shiftrightunsigned(h, {64 - k * CELL_BITS}) & {(1 << CELL_BITS) - 1}")
    cut = plan_df.where("rest > 0").select("pattern", F.col("rest").alias("left"), F.lit(0.0).alias("before"))
    keys = ["pattern"]
    for k in (1, 2):  # the cell in which the rest runs out, among 4,096, then among 4,096 within it
        cells = rows.withColumn("c1", cell(1)).withColumn("c2", cell(2)).join(F.broadcast(cut.select(*keys)), keys)
        cells = cells.groupBy(*keys, f"c{k}").agg(F.sum("size").alias("n"))
        run = F.sum("n").over(Window.partitionBy(*keys).orderBy(f"c{k}"))
        after = cells.withColumn("upto", run).join(F.broadcast(cut), keys).where(F.col("upto") + F.col("before") >= F.col("left"))
        first = after.groupBy(*keys).agg(F.min(F.struct(f"c{k}", "upto", "n", "left", "before")).alias("m"))
        cut = stage(first.select(*keys, f"m.c{k}", "m.left", (F.col("m.before") + F.col("m.upto") - F.col("m.n")).alias("before")), "mix-cut")
        keys.append(f"c{k}")
    # What is left lies in one of 16.7 million cells of a pattern: a handful of rows are put in order.
    final = cut.select("pattern", F.col("c1").alias("k1"), F.col("c2").alias("k2"), "left", "before")
    placed = rows.withColumns({"c1": cell(1), "c2": cell(2)}).join(plan_df, "pattern", "left").join(F.broadcast(final), "pattern", "left")
    inside = (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2"))
    last = placed.where(inside).select("pattern", "h", "size", "left", "before").groupBy("pattern", "h", "left", "before").agg(
        F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("pattern").orderBy("h")) + F.col("before")
    # A row is taken when at least half of it fits.
    bound = last.withColumn("upto", upto).where(F.col("upto") - F.col("n") / 2 <= F.col("left")).groupBy("pattern").agg(F.max("h").alias("bound"))
    bound = stage(bound, "mix-bound")
    out = placed.join(F.broadcast(bound), "pattern", "left")
    earlier = F.col("rest").isNotNull() & (F.col("rest") > 0) & (
        (F.col("c1") < F.col("k1")) | ((F.col("c1") == F.col("k1")) & (F.col("c2") < F.col("k2")))
        | (inside & F.coalesce(F.col("h") <= F.col("bound"), F.lit(False))))
    copies = F.coalesce(F.col("full"), F.lit(0)) + F.when(F.coalesce(earlier, F.lit(False)), 1).otherwise(0)
    return out.select("row", "size", "pattern", F.least(copies, F.lit(most)).alias("copies")), routes


def ranked_weights(sources: list) -> dict:
    """Weights 1, 2, 3, repeating, in the order of the sources."""
    return {s: 1.0 + i % 3 for i, s in enumerate(sources)}


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` as the mix takes them: a row as many times as it is repeated, none for a row left out."""
    taken, _ = mix(docs, n_words(F.col(f"`{text}`")), F.array(F.col(f"`{source}`")), ranked_weights, doc_id)
    times = taken.where("copies > 0").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return times.select("row.*")
