"""Joins: J1-J14."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import access, joins, quality, volume, warehouse, windows
from ..sources.tables import Tables
from . import bindings as b
from .aggregates import RATING_SQL
from .registry import query


@query("j01_join_header", b.sql("detalle pedidos", """
    SELECT id_detalle, id_pedido, cantidad, subtotal::DOUBLE AS subtotal, fecha_pedido, canal_interno FROM detalle JOIN pedidos USING (id_pedido)"""))
def _(t: Tables):
    return joins.join_header(b.detalle(t), b.pedidos(t)).select(
        "id_detalle", "id_pedido", "cantidad", "subtotal", "fecha_pedido", "canal_interno")


@query("j02_star_view", b.sql("star_view", """
    SELECT sk_venta, anio_mes, categoria, nombre_plato, canal, turno, metodo_pago, cargo, distrito, es_cliente_identificado,
      importe_neto::DOUBLE AS importe_neto FROM star_view"""))
def _(t: Tables):
    return warehouse.star_view(b.star(t)).select(
        "sk_venta", "anio_mes", "categoria", "nombre_plato", "canal", "turno", "metodo_pago", "cargo", "distrito",
        "es_cliente_identificado", "importe_neto")


@query("j03_attach_holiday", b.sql("pedidos holidays", """
    SELECT id_pedido, fecha_pedido, feriado FROM pedidos LEFT JOIN holidays ON fecha = fecha_pedido"""))
def _(t: Tables):
    return joins.attach(
        b.pedidos(t), b.holidays(t).withColumnRenamed("fecha", "fecha_pedido"), "fecha_pedido"
    ).select("id_pedido", "fecha_pedido", "feriado")


@query("j04_lookup", b.sql("pedidos dim_cliente", """
    SELECT id_pedido, id_cliente, sk_cliente FROM
      (SELECT id_pedido, CASE WHEN id_pedido % 17 = 0 THEN -1 ELSE id_cliente END AS id_cliente FROM pedidos)
      LEFT JOIN dim_cliente ON id_cliente_nk = id_cliente"""))
def _(t: Tables):
    orders = b.pedidos(t).select("id_pedido", F.expr("CASE WHEN id_pedido % 17 = 0 THEN -1 ELSE id_cliente END").alias("id_cliente"))
    return joins.lookup(orders, b.star(t)["dim_cliente"], "id_cliente", "id_cliente_nk", "sk_cliente")


@query("j05_lookup_normalised", b.sql("feed platos", f"""
    SELECT order_ref, plato, p.nombre_plato, p.id_plato FROM feed f
    LEFT JOIN platos p ON {b._NORM.format('p.nombre_plato')} = {b._NORM.format('f.plato')} WHERE copia = 1"""))
def _(t: Tables):
    return joins.lookup_normalised(b.feed(t).filter("copia = 1"), b.platos(t), "plato", "nombre_plato", "id_plato").select(
        "order_ref", "plato", "nombre_plato", "id_plato")


@query("j06_keep_accepted", b.sql("detalle pedidos", """
    SELECT id_detalle, id_pedido, subtotal::DOUBLE AS subtotal FROM detalle d
    WHERE EXISTS (SELECT 1 FROM pedidos p WHERE p.id_pedido = d.id_pedido AND monto_total > 100000)"""))
def _(t: Tables):
    kept = joins.keep_accepted(b.detalle(t), b.pedidos(t).filter("monto_total > 100000"))
    return kept.select("id_detalle", "id_pedido", "subtotal")


@query("j07_find_orphans", b.sql("detalle pedidos", """
    SELECT id_detalle, id_pedido, subtotal::DOUBLE AS subtotal FROM detalle d
    WHERE NOT EXISTS (SELECT 1 FROM pedidos p WHERE p.id_pedido = d.id_pedido AND monto_total > 100000)"""))
def _(t: Tables):
    orphans = joins.find_orphans(b.detalle(t), b.pedidos(t).filter("monto_total > 100000"))
    return orphans.select("id_detalle", "id_pedido", "subtotal")


@query("j08_check_fk", b.sql("pedidos clientes detalle platos", """
    SELECT 'id_cliente' AS columna, count(*) AS faltantes FROM pedidos WHERE id_cliente NOT IN (SELECT id_cliente FROM clientes)
    UNION ALL SELECT 'id_plato', count(*) FROM detalle WHERE id_plato NOT IN (SELECT id_plato FROM platos)"""))
def _(t: Tables):
    return quality.check_fk(b.pedidos(t), "id_cliente", b.clientes(t), "id_cliente").unionByName(
        quality.check_fk(b.detalle(t), "id_plato", b.platos(t), "id_plato"))


@query("j09_diff_images", b.sql("pedidos", """
    SELECT a.id_pedido, a.monto_total::DOUBLE AS antes, d.monto_total::DOUBLE AS despues FROM pedidos a
    JOIN (SELECT id_pedido, CASE WHEN id_pedido % 5 = 0 THEN monto_total + 1 ELSE monto_total END AS monto_total FROM pedidos
          WHERE canal_interno <> 'Salón') d USING (id_pedido) WHERE a.monto_total <> d.monto_total"""))
def _(t: Tables):
    before = b.pedidos(t)
    after = before.filter("canal_interno <> 'Salón'").withColumn(
        "monto_total", F.expr("CASE WHEN id_pedido % 5 = 0 THEN monto_total + 1 ELSE monto_total END"))
    return joins.diff_images(before, after, "id_pedido", "monto_total").filter("antes <> despues")


@query("j10_replicate", """
    SELECT l_returnflag, k, count(*) AS filas, sum(CAST(l_extendedprice AS DECIMAL(12,2)))::DOUBLE AS ventas
    FROM lineitem, range(1, 11) r(k) GROUP BY 1, 2""")
def _(t: Tables):
    rows = t.lineitem.select("l_returnflag", F.col("l_extendedprice").cast("decimal(12,2)").alias("v"))
    return volume.replicate(rows, 10).groupBy("l_returnflag", F.col("k").cast("bigint").alias("k")).agg(
        F.count(F.lit(1)).alias("filas"), F.sum("v").alias("ventas"))


@query("j11_sales_vs_rating", b.sql("sales resenas", RATING_SQL))
def _(t: Tables):
    return joins.sales_vs_rating(b.by_dish(t), b.resenas(t))


@query("j12_top_units_named", """
    SELECT p_brand AS nombre_plato, l_partkey AS id_plato, CAST(sum(l_quantity) AS BIGINT) AS unidades
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2 ORDER BY 3 DESC, 2 LIMIT 5""")
def _(t: Tables):
    units = t.lineitem.groupBy(F.col("l_partkey").alias("id_plato")).agg(F.sum(F.col("l_quantity").cast("int")).alias("unidades"))
    return windows.top_k(units, "unidades", 5, ["id_plato"]).join(b.dishes(t).select("id_plato", "nombre_plato"), "id_plato")


def attendance_by_role(attendance, employees):
    """Working days, mean hours and mean delay per role; attendance is summed per employee first."""
    days = attendance.groupBy("id_empleado").agg(
        F.count(F.lit(1)).alias("n"), F.sum("horas_trabajadas").alias("h"), F.sum("tardanza_min").alias("m"))
    roles = days.join(employees.select("id_empleado", "cargo"), "id_empleado").groupBy("cargo").agg(
        F.sum("n").alias("jornadas"), F.sum("h").alias("h"), F.sum("m").alias("m"))
    return roles.select("cargo", "jornadas", F.round(F.col("h").cast("double") / F.col("jornadas"), 2).alias("horas_prom"),
                        F.round(F.col("m") / F.col("jornadas"), 1).alias("tardanza_prom_min"))


@query("j13_attendance_by_role", """
    SELECT n_name AS cargo, count(*) AS jornadas, round(sum(CAST(l_quantity AS DECIMAL(5,2)))::DOUBLE / count(*), 2) AS horas_prom,
      round(sum(l_linenumber)::DOUBLE / count(*), 1) AS tardanza_prom_min
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1""")
def _(t: Tables):
    attendance = t.lineitem.select(
        F.col("l_suppkey").alias("id_empleado"), F.col("l_quantity").cast("decimal(5,2)").alias("horas_trabajadas"),
        F.col("l_linenumber").alias("tardanza_min"))
    employees = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id_empleado"), F.col("n_name").alias("cargo"))
    return attendance_by_role(attendance, employees)


@query("j14_kitchen_view", b.sql("detalle pedidos platos", """
    SELECT id_pedido, hora_pedido, canal_interno, nombre_plato, cantidad FROM pedidos JOIN detalle USING (id_pedido)
    JOIN platos USING (id_plato) WHERE fecha_pedido = DATE '1997-01-03'"""))
def _(t: Tables):
    return access.kitchen_view(b.pedidos(t), b.detalle(t), b.platos(t), dt.date(1997, 1, 3))
