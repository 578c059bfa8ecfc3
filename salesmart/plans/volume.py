"""Volume test: B1-B4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import volume
from ..session import staging_dir
from ..sources import feeds
from ..sources.tables import Tables
from . import bindings as b
from .registry import query


def _rows(t: Tables):
    return b.lines(t).select("id_plato", "l_returnflag", "importe_neto", "cantidad")


@query("b01_replicate_counts", """
    SELECT 'x' || k AS tabla, k * count(*) AS filas FROM lineitem, (VALUES (1), (10), (50)) v(k) GROUP BY k""")
def _(t: Tables):
    rows = t.lineitem.select("l_returnflag")
    parts = [volume.replicate(rows, k).agg(F.lit(f"x{k}").alias("tabla"), F.count(F.lit(1)).alias("filas")) for k in (1, 10, 50)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _bench(k: int) -> None:
    @query(f"b02_bench_x{k}", b.sql("sales", f"""
        SELECT nombre_plato, l_returnflag, ({k} * sum(importe_neto))::DOUBLE AS ventas, CAST({k} * sum(cantidad) AS BIGINT) AS unidades
        FROM sales GROUP BY 1, 2"""))
    def _(t: Tables):
        replicas = volume.replicate(_rows(t), k)
        return b.in_units(volume.bench_agg(replicas, b.dishes(t), "id_plato", "nombre_plato", "l_returnflag", "importe_neto", "cantidad"), "ventas")


for _k in (1, 10, 50):
    _bench(_k)


@query("b03_end_to_end", b.sql("sales", """
    SELECT nombre_plato, l_returnflag, sum(importe_neto)::DOUBLE AS ventas, CAST(sum(cantidad) AS BIGINT) AS unidades FROM sales GROUP BY 1, 2"""))
def _(t: Tables):
    path = staging_dir(t.spark, "bench_csv")
    b.in_units(_rows(t)).write.option("header", True).csv(path)
    fact = feeds.read_csv(t.spark, path, "id_plato bigint, l_returnflag string, importe_neto decimal(12,2), cantidad int")
    return volume.bench_agg(fact, b.dishes(t), "id_plato", "nombre_plato", "l_returnflag", "importe_neto", "cantidad")


@query("b04_timings_median", """
    SELECT event_type AS tabla, max(user_id) AS filas, round(quantile_disc(event_id * 1000, 0.5) / 1000000, 3) AS mediana_segundos FROM events GROUP BY 1""")
def _(t: Tables):
    rows = t.events.select(F.col("event_type").alias("tabla"), F.col("user_id").alias("filas"), (F.col("event_id") * 1000).alias("microseg"))
    return volume.timings_median(rows)
