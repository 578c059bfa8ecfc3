"""Scalar expressions: F1-F24."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import arrays, calendar, masks, money, text
from ..operators import volume, warehouse
from ..sources.tables import Tables
from . import bindings as b
from .registry import query


@query("f01_norm_name", b.sql("feed", f"SELECT order_ref, copia, {b._NORM.format('plato')} AS nombre FROM feed"))
def _(t: Tables):
    return b.feed(t).select("order_ref", "copia", text.norm_name(F.col("plato")).alias("nombre"))


@query("f01_norm_text", f"SELECT doc_id, {b._NORM.format('text')} AS nombre FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", text.norm_name(F.col("text")).alias("nombre"))


@query("f02_hash_id", b.sql("clientes", f"SELECT id_cliente, upper(sha256('{b.SALT}' || dni)) AS dni_hash FROM clientes"))
def _(t: Tables):
    return b.clientes(t).select("id_cliente", masks.hash_id(F.col("dni"), b.SALT).alias("dni_hash"))


@query("f03_shift", """
    SELECT event_id, CASE WHEN hour(ts) < 15 THEN 'Almuerzo (11-15h)' WHEN hour(ts) < 18 THEN 'Tarde (15-18h)' ELSE 'Noche (18-22h)' END AS turno FROM events""")
def _(t: Tables):
    return t.events.select("event_id", calendar.shift_of(F.date_format("ts", "HH:mm")).alias("turno"))


@query("f04_price_band", """
    SELECT p_partkey, CASE WHEN p_size - 1 <= 0 THEN NULL WHEN p_size - 1 <= 15 THEN 'Económico (<=15)' WHEN p_size - 1 <= 30 THEN 'Medio (16-30)'
      WHEN p_size - 1 <= 40 THEN 'Alto (31-40)' WHEN p_size - 1 <= 1000 THEN 'Premium (>40)' END AS rango_precio FROM part""")
def _(t: Tables):
    return t.part.select("p_partkey", money.price_band(F.col("p_size") - 1).alias("rango_precio"))


@query("f05_sale_size", """
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'Sin monto' WHEN value * 4 > 150 THEN 'Venta Grande' ELSE 'Venta Pequeña' END AS tamano FROM events""")
def _(t: Tables):
    amount = F.expr("CASE WHEN event_id % 10 = 0 THEN NULL ELSE value * 4 END")
    return t.events.select("event_id", money.sale_size(amount).alias("tamano"))


@query("f06_valid_id_flag", b.sql("stg_cliente", """
    SELECT id_cliente, copia, CASE WHEN dni IS NOT NULL AND length(dni) = 8 AND regexp_full_match(dni, '[0-9]*') THEN 1 ELSE 0 END AS valido FROM stg_cliente"""))
def _(t: Tables):
    return b.stg_cliente(t).select("id_cliente", "copia", text.valid_id_flag(F.col("dni")).alias("valido"))


@query("f07_safe_date", b.sql("stg_pedido", "SELECT id_pedido, copia, CAST(try_strptime(fecha_pedido, '%d/%m/%Y') AS DATE) AS fecha FROM stg_pedido"))
def _(t: Tables):
    return b.stg_pedido(t).select("id_pedido", "copia", calendar.safe_date(F.col("fecha_pedido")).alias("fecha"))


@query("f08_safe_cast", b.sql("stg_pedido", """
    SELECT id_pedido, copia, TRY_CAST(nullif(id_cliente, '') AS BIGINT) AS cliente, TRY_CAST(nullif(monto_total, '') AS DECIMAL(12,2))::DOUBLE AS monto FROM stg_pedido"""))
def _(t: Tables):
    return b.stg_pedido(t).select(
        "id_pedido", "copia", text.safe_cast(F.col("id_cliente"), "bigint").alias("cliente"),
        text.safe_cast(F.col("monto_total"), "decimal(12,2)").alias("monto"))


@query("f09_or_default", b.sql("stg_pedido", "SELECT id_pedido, copia, coalesce(TRY_CAST(nullif(id_cliente, '') AS BIGINT), 9999) AS cliente FROM stg_pedido"))
def _(t: Tables):
    return b.stg_pedido(t).select(
        "id_pedido", "copia", text.or_default(text.safe_cast(F.col("id_cliente"), "bigint"), 9999).alias("cliente"))


@query("f10_calendar_parts", """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS sk_fecha, CAST(o_orderdate AS DATE) AS fecha, year(o_orderdate) AS anio,
      quarter(o_orderdate) AS trimestre, month(o_orderdate) AS mes_num,
      ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Setiembre','Octubre','Noviembre','Diciembre'][month(o_orderdate)] AS mes_nombre,
      strftime(o_orderdate, '%Y-%m') AS anio_mes, weekofyear(o_orderdate) AS semana_iso, day(o_orderdate) AS dia_mes,
      isodow(o_orderdate) AS dia_semana_num,
      ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(o_orderdate)] AS dia_semana,
      CAST(isodow(o_orderdate) >= 6 AS INT) AS es_fin_semana FROM orders""")
def _(t: Tables):
    parts = calendar.calendar_parts(F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", *[c.alias(name) for name, c in parts.items()])


@query("f11_date_spine", """
    SELECT CAST(d AS DATE) AS fecha, count(o_orderkey) AS pedidos FROM range(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) r(d)
    LEFT JOIN orders ON o_orderdate = d GROUP BY 1""")
def _(t: Tables):
    spine = calendar.date_spine(t.spark, dt.date(1995, 1, 1), dt.date(2001, 12, 30))
    per_day = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("fecha")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(per_day, "fecha", "left").select("fecha", F.coalesce("n", F.lit(0)).alias("pedidos"))


@query("f12_tenure_months", """
    SELECT o_orderkey, CAST(round_even((DATE '2001-08-01' - CAST(o_orderdate AS DATE)) / 30.4::DOUBLE, 0) AS INT) AS meses FROM orders""")
def _(t: Tables):
    return t.orders.select("o_orderkey", calendar.tenure_months(F.col("o_orderdate").cast("date"), b.AS_OF).alias("meses"))


@query("f13_money", """
    SELECT l_orderkey, l_linenumber, l_partkey, round_even(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)::DOUBLE AS comision,
      round_even(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.35, 1)::DOUBLE AS una FROM lineitem""")
def _(t: Tables):
    price, pct = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", money.money(price * pct).alias("comision"),
        money.money(price * F.lit("0.35").cast("decimal(3,2)"), 1).alias("una"))


@query("f14_labels", """
    SELECT o_orderkey, 'SQL-' || o_orderkey AS ref, 'C-' || CASE WHEN o_custkey < 10000 THEN lpad(o_custkey::VARCHAR, 5, '0') ELSE o_custkey::VARCHAR END AS seudonimo,
      o_orderstatus || ' ' || o_orderpriority AS nombre, year(o_orderdate) || '-T' || quarter(o_orderdate) AS anio_trimestre FROM orders""")
def _(t: Tables):
    return t.orders.select(
        "o_orderkey", text.order_ref("SQL-", F.col("o_orderkey")).alias("ref"), text.customer_label(F.col("o_custkey")).alias("seudonimo"),
        text.full_name(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("nombre"),
        text.quarter_label(F.year("o_orderdate"), F.quarter("o_orderdate")).alias("anio_trimestre"))


@query("f15_pad_id", "SELECT o_orderkey, right('00000000' || (o_orderkey * 99991), 8) AS dni FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", text.pad_id(F.col("o_orderkey") * 99991).alias("dni"))


@query("f16_counter_text", """
    SELECT o_custkey, 'pedidos=' || count(*) || '; altos=' || coalesce(max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey END)::VARCHAR, '') AS texto
    FROM orders GROUP BY 1""")
def _(t: Tables):
    counted = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_orderkey"))).alias("h"))
    return counted.select("o_custkey", text.counter_text(pedidos=F.col("n"), altos=F.col("h")).alias("texto"))


@query("f17_ratio", "SELECT event_id, value / nullif(event_id % 5, 0) AS cociente FROM events")
def _(t: Tables):
    return t.events.select("event_id", money.ratio(F.col("value"), F.col("event_id") % 5).alias("cociente"))


@query("f18_differs", b.sql("detalle", """
    SELECT id_detalle, subtotal::DOUBLE AS subtotal, CAST(abs(subtotal - cantidad * precio_unitario) > 0.01 AS INT) AS distinto FROM detalle"""))
def _(t: Tables):
    return b.detalle(t).select("id_detalle", "subtotal", money.differs(
        F.col("subtotal"), F.col("cantidad") * F.col("precio_unitario")).cast("int").alias("distinto"))


@query("f19_field", b.sql("resenas", "SELECT _id, ocasion, acompanantes FROM resenas"))
def _(t: Tables):
    return b.resenas(t).select("_id", "visita.ocasion", "visita.acompanantes")


@query("f20_explode_tags", b.sql("resenas", "SELECT _id, unnest(etiquetas) AS etiqueta FROM resenas"))
def _(t: Tables):
    return b.resenas(t).select("_id", F.explode("etiquetas").alias("etiqueta"))


@query("f21_array_functions", b.sql("resenas", """
    SELECT _id, CAST(list_contains(etiquetas, 'red') AS INT) AS tiene, CAST(list_has_any(etiquetas, ['blue','bolt']) AS INT) AS alguno,
      CAST(coalesce(list_has_all(etiquetas, ['red','bolt']), false) AS INT) AS todos,
      array_to_string(list_append(coalesce(etiquetas, []), 'nuevo'), ' ') AS agregado FROM resenas"""))
def _(t: Tables):
    tags = F.col("etiquetas")
    return b.resenas(t).select(
        "_id", arrays.has(tags, "red").cast("int").alias("tiene"), arrays.has_any(tags, ["blue", "bolt"]).cast("int").alias("alguno"),
        arrays.has_all(tags, ["red", "bolt"]).cast("int").alias("todos"), F.array_join(arrays.push(tags, "nuevo"), " ").alias("agregado"))


@query("f22_sale_amounts", b.sql("clean_feed fact_external", """
    SELECT nro_pedido AS order_ref, precio_unitario::DOUBLE AS precio_unitario, importe_bruto::DOUBLE AS importe_bruto,
      comision_plataforma::DOUBLE AS comision_plataforma, importe_neto::DOUBLE AS importe_neto, costo_total::DOUBLE AS costo_total,
      (importe_neto - costo_total)::DOUBLE AS margen_bruto FROM fact_external"""))
def _(t: Tables):
    feed = warehouse.clean_feed(b.feed(t), b.platos(t), b.FIRST).join(b.platos(t).select("id_plato", "costo_estimado"), "id_plato")
    amounts = money.sale_amounts(F.col("precio_bruto"), F.col("comision_pct"), F.col("cantidad"), F.col("costo_estimado"))
    return feed.select("order_ref", *[c.alias(name) for name, c in amounts.items()])


@query("f23_as_text", """
    SELECT CAST(o_orderkey AS STRING) AS id, strftime(o_orderdate, '%Y-%m-%d') AS fecha, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) AS monto FROM orders""")
def _(t: Tables):
    return t.orders.select(
        text.as_text(F.col("o_orderkey")).alias("id"), text.as_text(F.col("o_orderdate"), "yyyy-MM-dd").alias("fecha"),
        text.as_text(F.col("o_totalprice").cast("decimal(12,2)")).alias("monto"))


@query("f24_median3", """
    SELECT event_type AS tabla, max(user_id) AS filas, round(quantile_disc(CAST(value * 100 AS BIGINT), 0.5) / 1000000, 3) AS mediana_segundos
    FROM events GROUP BY 1""")
def _(t: Tables):
    rows = t.events.select(F.col("event_type").alias("tabla"), F.col("user_id").alias("filas"),
                           F.round(F.col("value") * 100).cast("bigint").alias("microseg"))
    return volume.timings_median(rows)
