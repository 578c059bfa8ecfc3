"""Functions and procedures as callable surfaces: V1-V5."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import calendar, masks, text
from ..operators import quality
from ..sources.tables import Tables
from . import bindings as b
from .aggregates import sales_by_category
from .quality import ACCEPTED, LINES
from .registry import query


@query("v01_sql_function", """
    SELECT o_orderkey, CASE WHEN o_totalprice > 150 THEN 'Venta Grande' ELSE 'Venta Pequeña' END AS tamano FROM orders""")
def _(t: Tables):
    t.spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION categoria_venta(monto DECIMAL(12,2)) RETURNS STRING
        RETURN CASE WHEN monto IS NULL THEN 'Sin monto' WHEN monto > 150 THEN 'Venta Grande' ELSE 'Venta Pequeña' END""")
    t.orders.createOrReplaceTempView("orders")
    return t.spark.sql("SELECT o_orderkey, categoria_venta(CAST(o_totalprice AS DECIMAL(12,2))) AS tamano FROM orders")


_BY_CATEGORY = b.sql("sales", """
    SELECT categoria, count(DISTINCT id_pedido) AS pedidos, CAST(sum(cantidad) AS BIGINT) AS unidades, sum(importe_neto)::DOUBLE AS ventas,
      sum(margen_bruto)::DOUBLE AS margen_bruto FROM sales WHERE fecha BETWEEN DATE '1997-01-01' AND DATE '1997-06-30' GROUP BY 1""")


@query("v03_sales_by_category", _BY_CATEGORY)
def _(t: Tables):
    return sales_by_category(t, dt.date(1997, 1, 1), dt.date(1997, 6, 30))


def create_sales_function(t: Tables) -> None:
    """``ventas_por_categoria(desde, hasta)`` as a table function of this session, for any SQL text.

    Lines are summed per order and category first, so orders are counted without a distinct count.
    """
    b.in_units(b.with_dish(b.lines(t), t)).createOrReplaceTempView("ventas_lineas")
    b.heads(t).createOrReplaceTempView("ventas_pedidos")
    t.spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION ventas_por_categoria(desde DATE, hasta DATE)
        RETURNS TABLE (categoria STRING, pedidos BIGINT, unidades BIGINT, ventas DECIMAL(38,2), margen_bruto DECIMAL(38,2))
        RETURN SELECT categoria, count(*), sum(unidades), sum(ventas), sum(margen) FROM (
            SELECT l.categoria, l.id_pedido, sum(l.cantidad) AS unidades, sum(l.importe_neto) AS ventas, sum(l.margen_bruto) AS margen
            FROM ventas_lineas l JOIN ventas_pedidos p ON p.id_pedido = l.id_pedido
            WHERE p.fecha BETWEEN ventas_por_categoria.desde AND ventas_por_categoria.hasta GROUP BY l.categoria, l.id_pedido)
          GROUP BY categoria""")


@query("v03_table_function", _BY_CATEGORY)
def _(t: Tables):
    create_sales_function(t)
    return t.spark.sql("SELECT * FROM ventas_por_categoria(DATE '1997-01-01', DATE '1997-06-30')")


@query("v04_element_functions", b.sql("platos pedidos", f"""
    SELECT id_pedido, {b._NORM.format("canal_interno")} AS canal_norm, upper(sha256('{b.SALT}' || id_cliente)) AS cliente_hash,
      CASE WHEN CAST(left(hora_pedido, 2) AS INT) < 15 THEN 'Almuerzo (11-15h)' WHEN CAST(left(hora_pedido, 2) AS INT) < 18 THEN 'Tarde (15-18h)'
        ELSE 'Noche (18-22h)' END AS turno,
      ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Setiembre','Octubre','Noviembre','Diciembre'][month(fecha_pedido)] AS mes
    FROM pedidos"""))
def _(t: Tables):
    return b.pedidos(t).select(
        "id_pedido", text.norm_name(F.col("canal_interno")).alias("canal_norm"), masks.hash_id(F.col("id_cliente"), b.SALT).alias("cliente_hash"),
        calendar.shift_of(F.col("hora_pedido")).alias("turno"), calendar.month_name(F.month("fecha_pedido")).alias("mes"))


@query("v05_load_orders", b.sql("stg_pedido", f"""
    WITH {ACCEPTED} SELECT id_pedido, fecha_pedido, hora_pedido, id_cliente, id_empleado, canal_interno, metodo_pago, monto_total::DOUBLE AS monto_total, fecha_imputada FROM ok"""))
def _(t: Tables):
    return quality.load_orders(b.stg_pedido(t), b.stg_detalle(t), b.FIRST, b.LOAD_DATE)["pedidos"]


@query("v05_load_lines", b.sql("stg_pedido stg_detalle", f"""
    WITH {ACCEPTED}, {LINES} SELECT id_detalle, id_pedido, id_plato, cantidad, precio_unitario::DOUBLE AS precio_unitario, subtotal::DOUBLE AS subtotal
    FROM lin WHERE id_pedido IN (SELECT id_pedido FROM ok)"""))
def _(t: Tables):
    return quality.load_orders(b.stg_pedido(t), b.stg_detalle(t), b.FIRST, b.LOAD_DATE)["detalle"]
