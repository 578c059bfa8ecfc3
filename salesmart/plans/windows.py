"""Windows, sorts, top-k: W1-W7, T1-T4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, olap, stats, windows
from ..operators.measures import category_share
from ..sources.tables import Tables
from . import bindings as b
from .aggregates import shifts, SHIFTS
from .registry import query

LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("w01_dedupe_first", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER
      (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""")
def _(t: Tables):
    first = windows.dedupe_first(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("w02_top3_per_month", b.sql("sales", """
    SELECT anio_mes, nombre_plato, v, rk FROM (SELECT *, CAST(row_number() OVER (PARTITION BY anio_mes ORDER BY v DESC, nombre_plato) AS INT) AS rk
      FROM (SELECT anio_mes, nombre_plato, round(sum(importe_neto)::DOUBLE, 0) AS v FROM sales GROUP BY 1, 2)) WHERE rk <= 3"""))
def _(t: Tables):
    monthly = olap.sum_by(b.by_order(t, "nombre_plato", dish=True), ["anio_mes", "nombre_plato"], {"s": "importe_neto"})
    rounded = monthly.select("anio_mes", "nombre_plato", F.round(F.col("s").cast("double"), 0).alias("v"))
    return windows.top_n_per_group(rounded, ["anio_mes"], "v", 3, ["nombre_plato"]).orderBy("anio_mes", "rk")


@query("w03_surrogate_key", """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS sk, o_orderkey, CAST(o_orderdate AS DATE) AS fecha FROM orders""")
def _(t: Tables):
    orders = t.orders.select(F.col("o_orderdate").cast("date").alias("fecha"), "o_orderkey")
    return windows.surrogate_key(orders, ["fecha", "o_orderkey"], "sk")


@query("w04_median_disc_over", """
    SELECT DISTINCT l_returnflag, l_linestatus, count(*) OVER w AS filas, quantile_disc(l_quantity, 0.5) OVER w AS mediana
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag, l_linestatus)""")
def _(t: Tables):
    return stats.median_disc_over(t.lineitem, ["l_returnflag", "l_linestatus"], "l_quantity")


@query("w06_category_share", b.sql("sales", """
    SELECT canal, categoria, sum(importe_neto)::DOUBLE AS net_sales,
      sum(importe_neto)::DOUBLE / (sum(sum(importe_neto)) OVER (PARTITION BY canal))::DOUBLE AS category_share FROM sales GROUP BY 1, 2"""))
def _(t: Tables):
    return category_share(b.by_order(t, "categoria", dish=True), "canal")


def yoy_sql(keys: str) -> str:
    """Growth on the previous year at a grain given as columns after the year."""
    more = "".join(f", {k}" for k in keys.split())
    on = " AND ".join(["p.anio = c.anio - 1", *[f"p.{k} = c.{k}" for k in keys.split()]])
    return f"""WITH m AS (SELECT anio{more}, sum(importe_neto) AS net_sales FROM sales GROUP BY ALL)
    SELECT c.anio{more.replace(', ', ', c.')}, c.net_sales::DOUBLE AS net_sales, p.net_sales::DOUBLE AS net_sales_aa,
      (c.net_sales::DOUBLE - p.net_sales::DOUBLE) / nullif(p.net_sales::DOUBLE, 0) AS crecimiento FROM m c LEFT JOIN m p ON {on}"""


@query("w07_yoy_month", b.sql("sales", yoy_sql("mes_num")))
def _(t: Tables):
    monthly = olap.sum_by(b.by_order(t), ["anio", "mes_num"], {"net_sales": "importe_neto"})
    return windows.yoy(monthly, ["anio", "mes_num"], "net_sales")


@query("w07_yoy_quarter", b.sql("sales", yoy_sql("trimestre")))
def _(t: Tables):
    quarterly = olap.sum_by(b.by_order(t), ["anio", "trimestre"], {"net_sales": "importe_neto"})
    return windows.yoy(quarterly, ["anio", "trimestre"], "net_sales")


@query("w07_yoy_day", b.sql("sales", """
    WITH d AS (SELECT fecha, sum(importe_neto) AS net_sales FROM sales GROUP BY 1)
    SELECT c.fecha, c.net_sales::DOUBLE AS net_sales, p.net_sales::DOUBLE AS net_sales_aa,
      (c.net_sales::DOUBLE - p.net_sales::DOUBLE) / nullif(p.net_sales::DOUBLE, 0) AS crecimiento
    FROM d c LEFT JOIN d p ON p.fecha = CAST(c.fecha - INTERVAL 1 YEAR AS DATE)"""))
def _(t: Tables):
    daily = olap.sum_by(b.by_order(t), ["fecha"], {"net_sales": "importe_neto"})
    return windows.yoy(daily, ["fecha"], "net_sales")


@query("t01_sort", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def _(t: Tables):
    return t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice").orderBy(
        "o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("t02_top_units_in_month", b.sql("sales", """
    SELECT nombre_plato, CAST(sum(cantidad) AS BIGINT) AS unidades FROM sales WHERE fecha BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def _(t: Tables):
    month = b.heads(t).filter("fecha between date '1996-03-01' and date '1996-03-31'")
    sold = joins.keep_accepted(b.lines(t), month).groupBy("id_plato").agg(F.sum("cantidad").alias("n"))
    units = sold.join(b.dishes(t).select("id_plato", "nombre_plato"), "id_plato").groupBy("nombre_plato").agg(F.sum("n").alias("unidades"))
    return windows.top_k(units, "unidades", 10, ["nombre_plato"])


@query("t02_top8_by_sales", b.sql("sales", """
    SELECT nombre_plato, sum(importe_neto)::DOUBLE AS ventas FROM sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8"""))
def _(t: Tables):
    return windows.top_k(olap.sum_by(b.by_dish(t), ["nombre_plato"], {"ventas": "importe_neto"}), "ventas", 8, ["nombre_plato"])


@query("t03_sort_by_ordinal", f"SELECT dia_semana_num, dia_semana, sum(importe_neto)::DOUBLE AS ventas FROM {SHIFTS} GROUP BY 1, 2")
def _(t: Tables):
    return windows.sort_by_ordinal(olap.sum_by(shifts(t), ["dia_semana_num", "dia_semana"], {"ventas": "importe_neto"}), "dia_semana_num")
