"""Projections, filters, predicates: P1-P11."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import text
from ..operators import access, olap, quality, stats
from ..sources.tables import Tables
from . import bindings as b
from .registry import query


@query("p01_select", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")


@query("p02_rename", "SELECT p_partkey AS id_plato, p_name AS nombre_plato, p_type AS categoria FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", "p_name", "p_type").withColumnsRenamed(
        {"p_partkey": "id_plato", "p_name": "nombre_plato", "p_type": "categoria"})


def sales_by_day(orders, first: dt.date, last: dt.date):
    """Orders and amount per day; the range is on the raw column, so it reaches the scan."""
    after = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
    start = dt.datetime.combine(first, dt.time())
    kept = orders.filter((F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit(after).cast("timestamp_ntz")))
    return kept.groupBy(F.col("o_orderdate").cast("date").alias("fecha")).agg(
        F.count(F.lit(1)).alias("pedidos"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("ventas"))


@query("p03_sales_by_day", """
    SELECT CAST(o_orderdate AS DATE) AS fecha, count(*) AS pedidos, sum(CAST(o_totalprice AS DECIMAL(12,2)))::DOUBLE AS ventas
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-07' GROUP BY 1""")
def _(t: Tables):
    return sales_by_day(t.orders, dt.date(1996, 3, 1), dt.date(1996, 3, 7))


DICE = (1996, 1, ["ECONOMY", "SMALL"], ["MACHINERY", "FURNITURE"])


@query("p04_dice_predicate", b.sql("sales", """
    SELECT nro_pedido, categoria, metodo_pago, importe_neto::DOUBLE AS importe_neto FROM sales
    WHERE anio = 1996 AND trimestre = 1 AND categoria IN ('ECONOMY','SMALL') AND metodo_pago IN ('MACHINERY','FURNITURE')"""))
def _(t: Tables):
    rows = olap.dice(b.sales(t, dish=True, customer=True), *DICE)
    return b.in_units(rows.select("nro_pedido", "categoria", "metodo_pago", "importe_neto"))


@query("p05_slice_predicate", b.sql("sales", """
    SELECT nro_pedido, importe_neto::DOUBLE AS importe_neto FROM sales WHERE canal = '2-HIGH'"""))
def _(t: Tables):
    return b.in_units(olap.slice_(b.sales(t, order=True), "canal", "2-HIGH").select("nro_pedido", "importe_neto"))


@query("p06_null_counts", b.sql("clientes", """
    SELECT 'dni' AS columna, count(*) FILTER (WHERE dni IS NULL) AS nulos FROM clientes UNION ALL
    SELECT 'email', count(*) FILTER (WHERE email IS NULL) FROM clientes UNION ALL
    SELECT 'distrito', count(*) FILTER (WHERE distrito IS NULL) FROM clientes"""))
def _(t: Tables):
    return stats.null_counts(b.clientes(t), ["dni", "email", "distrito"])


@query("p07_valid_id", b.sql("stg_cliente", """
    SELECT id_cliente, dni, regexp_full_match(dni, '[0-9]{8}')::INT AS valido FROM stg_cliente WHERE copia = 1"""))
def _(t: Tables):
    rows = b.stg_cliente(t).filter("copia = 1")
    return rows.select("id_cliente", "dni", text.is_valid_id(F.col("dni")).cast("int").alias("valido"))


@query("p08_today_orders", b.sql("pedidos", """
    SELECT id_pedido, canal_interno, monto_total::DOUBLE AS monto_total FROM pedidos WHERE fecha_pedido = DATE '1997-01-03'"""))
def _(t: Tables):
    return access.today_orders(b.pedidos(t), dt.date(1997, 1, 3)).select("id_pedido", "canal_interno", "monto_total")


@query("p09_reject_amount", b.sql("stg_pedido", """
    SELECT id_pedido, TRY_CAST(monto_total AS DECIMAL(12,2))::DOUBLE AS monto FROM stg_pedido
    WHERE copia = 1 AND TRY_CAST(monto_total AS DECIMAL(12,2)) <= 0"""))
def _(t: Tables):
    _, bad = quality.reject_amount(b.stg_pedido(t).filter("copia = 1"))
    return bad.filter("monto_total is not null").select("id_pedido", F.col("monto_total").alias("monto"))


@query("p10_own_channels", b.sql("fact_ventas", """
    SELECT sk_canal, count(*) AS lineas, sum(importe_neto)::DOUBLE AS ventas FROM fact_ventas WHERE sk_canal <= 3 GROUP BY 1"""))
def _(t: Tables):
    own = b.star(t)["fact_ventas"].filter("sk_canal <= 3")
    return own.groupBy("sk_canal").agg(F.count(F.lit(1)).alias("lineas"), F.sum("importe_neto").alias("ventas"))


@query("p11_preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5)
