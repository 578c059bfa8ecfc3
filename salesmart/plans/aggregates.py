"""Aggregations: A1-A30."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import calendar, money
from ..operators import joins, olap, stats, volume, windows
from ..operators.measures import EXTERNAL, order_measures
from ..sources.tables import Tables
from . import bindings as b
from .registry import query

NET, MARGIN = {"ventas": "importe_neto"}, {"ventas": "importe_neto", "margen": "margen_bruto"}


def quarter_stats(t: Tables) -> DataFrame:
    """Sum, mean, max, min and count of line sales per quarter, from per-order partials."""
    partial = b.lines(t).groupBy("id_pedido").agg(
        F.sum("importe_neto").alias("s"), F.max("importe_neto").alias("mx"), F.min("importe_neto").alias("mn"),
        F.count(F.lit(1)).alias("n"))
    partial = b.in_units(partial, "s", "mx", "mn")
    total = F.sum("s").cast("double")
    return joins.join_header(partial, b.heads(t)).groupBy("anio", "trimestre").agg(
        F.round(total, 0).alias("acumulado"), F.round(total / F.sum("n"), 2).alias("promedio_linea"),
        F.max("mx").alias("maximo"), F.min("mn").alias("minimo"), F.sum("n").alias("lineas"))


@query("a01_quarter_stats", b.sql("sales", """
    SELECT anio, trimestre, round(sum(importe_neto)::DOUBLE, 0) AS acumulado, round(sum(importe_neto)::DOUBLE / count(*), 2) AS promedio_linea,
      max(importe_neto)::DOUBLE AS maximo, min(importe_neto)::DOUBLE AS minimo, count(*) AS lineas FROM sales GROUP BY 1, 2"""))
def _(t: Tables):
    return quarter_stats(t)


def category_margin(sold: DataFrame) -> DataFrame:
    net, margin = F.sum("importe_neto").cast("double"), F.sum("margen_bruto").cast("double")
    return sold.groupBy("categoria").agg(
        F.round(net, 2).alias("ventas"), F.sum("cantidad").alias("unidades"),
        F.round(F.try_divide(margin, net) * 100, 1).alias("margen_pct"))


@query("a02_category_margin", b.sql("sales", """
    SELECT categoria, round(sum(importe_neto)::DOUBLE, 2) AS ventas, CAST(sum(cantidad) AS BIGINT) AS unidades,
      round(sum(margen_bruto)::DOUBLE / sum(importe_neto)::DOUBLE * 100, 1) AS margen_pct FROM sales GROUP BY 1"""))
def _(t: Tables):
    return category_margin(b.by_dish(t))


def sales_by_category(t: Tables, first: dt.date, last: dt.date) -> DataFrame:
    """Distinct orders, units, sales and margin per category over a date range.

    Only lines of the range's orders are summed; one row per (order, category)
    is left before the order join, so distinct orders are a plain count there.
    """
    ranged = b.heads(t).filter(F.col("fecha").between(F.lit(first), F.lit(last)))
    per_order = b.by_order(t, "categoria", dish=True, orders=ranged)
    return per_order.groupBy("categoria").agg(
        F.count(F.lit(1)).alias("pedidos"), F.sum("cantidad").alias("unidades"),
        F.sum("importe_neto").alias("ventas"), F.sum("margen_bruto").alias("margen_bruto"))


@query("a03_sales_by_category", b.sql("sales", """
    SELECT categoria, count(DISTINCT id_pedido) AS pedidos, CAST(sum(cantidad) AS BIGINT) AS unidades, sum(importe_neto)::DOUBLE AS ventas,
      sum(margen_bruto)::DOUBLE AS margen_bruto FROM sales WHERE fecha BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' GROUP BY 1"""))
def _(t: Tables):
    return sales_by_category(t, dt.date(1996, 1, 1), dt.date(1996, 3, 31))


@query("a04_avg_non_null", b.sql("lines", """
    SELECT l_returnflag, sum(calificacion)::DOUBLE / count(calificacion) AS calificacion FROM lines GROUP BY 1"""))
def _(t: Tables):
    return stats.avg_non_null(b.lines(t), ["l_returnflag"], "calificacion", "calificacion")


def feed_profile(feed: DataFrame, key: str) -> DataFrame:
    """Raw feed, repeated refs included."""
    def mean(c: str, digits: int):
        return F.round(F.try_divide(F.sum(c).cast("double"), F.count(c)), digits)
    return feed.groupBy(key).agg(
        F.count(F.lit(1)).alias("pedidos"), F.round(F.sum("precio_bruto").cast("double"), 0).alias("venta_bruta"),
        mean("comision_pct", 1).alias("comision_prom_pct"), mean("tiempo_entrega_min", 1).alias("min_entrega"),
        mean("calificacion", 2).alias("calif"))


PROFILE = """SELECT {0}, count(*) AS pedidos, round(sum(precio_bruto)::DOUBLE, 0) AS venta_bruta,
      round(sum(comision_pct)::DOUBLE / count(comision_pct), 1) AS comision_prom_pct,
      round(sum(tiempo_entrega_min)::DOUBLE / count(tiempo_entrega_min), 1) AS min_entrega,
      round(sum(calificacion)::DOUBLE / count(calificacion), 2) AS calif FROM feed GROUP BY 1"""


@query("a05_feed_profile_platform", b.sql("feed", PROFILE.format("plataforma")))
def _(t: Tables):
    return feed_profile(b.feed(t), "plataforma")


@query("a05_feed_profile_district", b.sql("feed", PROFILE.format("distrito_entrega")))
def _(t: Tables):
    return feed_profile(b.feed(t), "distrito_entrega")


@query("a06_order_header", b.sql("sales", """
    SELECT nro_pedido, sum(importe_neto)::DOUBLE AS neto, min(id_cliente) AS cliente, min(es_cliente_identificado) AS ident FROM sales GROUP BY 1"""))
def _(t: Tables):
    sums = b.in_units(b.lines(t).groupBy("nro_pedido", "id_pedido").agg(F.sum("importe_neto").alias("neto")), "neto")
    return joins.join_header(sums, b.heads(t)).join(b.people(t), "id_cliente").select(
        "nro_pedido", "neto", F.col("id_cliente").alias("cliente"), F.col("es_cliente_identificado").alias("ident"))


REPEAT_SQL = """
    SELECT count(*) AS identified_customers, count(*) FILTER (WHERE n >= 2)::DOUBLE / count(*) AS repeat_pct
    FROM (SELECT id_cliente, count(DISTINCT nro_pedido) AS n FROM sales WHERE es_cliente_identificado = 1 GROUP BY 1)"""


@query("a07_repeat_customer_rate", b.sql("sales", REPEAT_SQL))
def _(t: Tables):
    return order_measures(b.by_ref(t, customer=True), names=["identified_customers", "repeat_pct"])


def _grouping(keys: str) -> str:
    return ", ".join(f"CAST(grouping({k.strip()}) AS INT) AS g_{k.strip()}" for k in keys.split(","))


def _flags(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in df.columns if c.startswith("g_")})


@query("a08_rollup_time", b.sql("sales", f"""
    SELECT anio, trimestre, anio_mes, sum(importe_neto)::DOUBLE AS ventas, sum(margen_bruto)::DOUBLE AS margen,
      {_grouping('anio, trimestre, anio_mes')} FROM sales GROUP BY ROLLUP (anio, trimestre, anio_mes)"""))
def _(t: Tables):
    return _flags(olap.rollup_sums(b.by_order(t, dish=True), ["anio", "trimestre", "anio_mes"], MARGIN))


@query("a09_rollup_channel", b.sql("sales", f"""
    SELECT anio, trimestre, canal, round(sum(importe_neto)::DOUBLE, 0) AS ventas, {_grouping('anio, trimestre, canal')}
    FROM sales GROUP BY ROLLUP (anio, trimestre, canal)"""))
def _(t: Tables):
    rolled = olap.rollup_sums(b.by_order(t), ["anio", "trimestre", "canal"], NET)
    return _flags(rolled.withColumn("ventas", F.round(F.col("ventas").cast("double"), 0)))


@query("a10_drill_rollup", b.sql("sales", f"""
    SELECT categoria, nombre_plato, sum(importe_neto)::DOUBLE AS ventas, CAST(sum(cantidad) AS BIGINT) AS unidades,
      {_grouping('categoria, nombre_plato')} FROM sales GROUP BY ROLLUP (categoria, nombre_plato)"""))
def _(t: Tables):
    return _flags(olap.rollup_sums(b.by_dish(t), ["categoria", "nombre_plato"], {"ventas": "importe_neto", "unidades": "cantidad"}))


@query("a11_cube_cat_channel", b.sql("sales", f"""
    SELECT categoria, canal, sum(importe_neto)::DOUBLE AS ventas, {_grouping('categoria, canal')} FROM sales GROUP BY CUBE (categoria, canal)"""))
def _(t: Tables):
    return _flags(olap.cube_sums(b.by_order(t, "categoria", dish=True), ["categoria", "canal"], NET))


def shifts(t: Tables) -> DataFrame:
    """Purchases with weekday and shift."""
    day = F.col("ts").cast("date")
    bought = t.events.filter("event_type = 'purchase'")
    return bought.select(
        calendar.weekday_number(day).alias("dia_semana_num"), calendar.weekday_name(calendar.weekday_number(day)).alias("dia_semana"),
        calendar.shift_of_hour(F.hour("ts")).alias("turno"), money.amount(F.col("value")).alias("importe_neto"))


SHIFTS = """(SELECT isodow(ts) AS dia_semana_num,
    ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(ts)] AS dia_semana,
    CASE WHEN hour(ts) < 15 THEN 'Almuerzo (11-15h)' WHEN hour(ts) < 18 THEN 'Tarde (15-18h)' ELSE 'Noche (18-22h)' END AS turno,
    CAST(value AS DECIMAL(12,2)) AS importe_neto FROM events WHERE event_type = 'purchase')"""


@query("a12_sets_weekday_shift", f"""
    SELECT dia_semana, turno, sum(importe_neto)::DOUBLE AS ventas, {_grouping('dia_semana, turno')} FROM {SHIFTS}
    GROUP BY GROUPING SETS ((dia_semana, turno), (dia_semana), ())""")
def _(t: Tables):
    return _flags(olap.grouping_sets(
        shifts(t), ["dia_semana", "turno"], [["dia_semana", "turno"], ["dia_semana"], []], NET))


@query("a13_cube_leaf", b.sql("sales", """
    SELECT anio, trimestre, categoria, canal, sum(importe_neto)::DOUBLE AS ventas FROM sales GROUP BY 1, 2, 3, 4"""))
def _(t: Tables):
    return olap.sum_by(b.by_order(t, "categoria", dish=True), ["anio", "trimestre", "categoria", "canal"], NET)


def pivot_weekday_shift(rows: DataFrame) -> DataFrame:
    """Weekday rows in calendar order, shift columns in day order."""
    wide = olap.pivot_sums(rows, ["dia_semana_num", "dia_semana"], "turno", calendar.SHIFTS, "importe_neto")
    return wide.orderBy("dia_semana_num").drop("dia_semana_num")


PIVOT_SQL = f"""SELECT dia_semana,
      sum(importe_neto) FILTER (WHERE turno = 'Almuerzo (11-15h)')::DOUBLE AS "Almuerzo (11-15h)",
      sum(importe_neto) FILTER (WHERE turno = 'Tarde (15-18h)')::DOUBLE AS "Tarde (15-18h)",
      sum(importe_neto) FILTER (WHERE turno = 'Noche (18-22h)')::DOUBLE AS "Noche (18-22h)" FROM {SHIFTS} GROUP BY 1"""


@query("a14_pivot_weekday_shift", PIVOT_SQL)
def _(t: Tables):
    return pivot_weekday_shift(shifts(t))


CHANNELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
MARGINS_SQL = "SELECT CASE WHEN grouping(categoria) = 1 THEN 'Total' ELSE categoria END AS categoria, " + ", ".join(
    f"round(sum(importe_neto) FILTER (WHERE canal = '{c}')::DOUBLE, 2) AS \"{c}\"" for c in CHANNELS
) + ", round(sum(importe_neto)::DOUBLE, 2) AS \"Total\" FROM sales GROUP BY ROLLUP (categoria)"


@query("a15_pivot_margins", b.sql("sales", MARGINS_SQL))
def _(t: Tables):
    return olap.pivot_margins(b.by_order(t, "categoria", dish=True), "categoria", "canal", CHANNELS, "importe_neto")


def _describe_sql(source: str, columns: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS columna, count({c}) AS n, sum({c})::DOUBLE / count({c}) AS media, round(stddev_samp({c}::DOUBLE), 4) AS desviacion, "
        f"min({c})::DOUBLE AS minimo, max({c})::DOUBLE AS maximo{extra.format(c)} FROM {source}" for c in columns)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("desviacion", F.round("desviacion", 4))


@query("a16_describe", b.sql("sales", _describe_sql("sales", ["cantidad", "precio_base", "importe_neto", "margen_bruto"])))
def _(t: Tables):
    return _rounded(stats.describe_cols(b.in_units(b.sales(t, dish=True)), ["cantidad", "precio_base", "importe_neto", "margen_bruto"]))


SUMMARY = ["importe_neto", "cantidad", "tiempo_entrega_min", "calificacion"]


@query("a17_summary", b.sql("lines", _describe_sql("lines", SUMMARY, ", " + ", ".join(
    f"quantile_disc({{0}}, {p / 100})::DOUBLE AS p{p}" for p in (25, 50, 75)))))
def _(t: Tables):
    return _rounded(stats.summary_cols(b.in_units(b.lines(t)), SUMMARY))


RATING_SQL = """
    SELECT nombre_plato, ventas::DOUBLE AS ventas, puntos::DOUBLE / n_resenas AS puntuacion_media, n_resenas
    FROM (SELECT nombre_plato, sum(importe_neto) AS ventas FROM sales GROUP BY 1)
    JOIN (SELECT plato, sum(puntuacion) AS puntos, count(*) AS n_resenas FROM resenas GROUP BY 1) ON plato = nombre_plato"""


@query("a18_corr_sales_rating", b.sql("sales resenas", f"SELECT round(corr(ventas, puntuacion_media), 8) AS r FROM ({RATING_SQL})"))
def _(t: Tables):
    pairs = joins.sales_vs_rating(b.by_dish(t), b.resenas(t))
    return stats.correlation(pairs, "ventas", "puntuacion_media").select(F.round("r", 8).alias("r"))


@query("a19_median_disc", b.sql("lines", """
    SELECT origen, l_returnflag, quantile_disc(importe_neto, 0.5)::DOUBLE AS mediana FROM lines GROUP BY 1, 2"""))
def _(t: Tables):
    return b.in_units(stats.median_disc(b.lines(t), ["origen", "l_returnflag"], "importe_neto"), "mediana")


@query("a20_having", b.sql("resenas", """
    SELECT id_cliente, count(*) AS resenas, sum(puntuacion)::DOUBLE / count(*) AS promedio FROM resenas
    WHERE id_cliente IS NOT NULL GROUP BY 1 HAVING count(*) >= 50"""))
def _(t: Tables):
    docs = b.resenas(t).filter("id_cliente is not null")
    per_client = docs.groupBy("id_cliente").agg(F.count(F.lit(1)).alias("resenas"), F.sum("puntuacion").cast("double").alias("s"))
    return per_client.filter("resenas >= 50").select("id_cliente", "resenas", (F.col("s") / F.col("resenas")).alias("promedio"))


@query("a21_failed_ids", b.sql("stg_pedido", """
    SELECT left(string_agg(id_pedido, ',' ORDER BY CAST(id_pedido AS BIGINT)), 200) AS ids FROM stg_pedido
    WHERE copia = 1 AND TRY_CAST(monto_total AS DECIMAL(12,2)) <= 0"""))
def _(t: Tables):
    bad = b.stg_pedido(t).filter(F.col("copia") == 1).filter(F.expr("try_cast(monto_total as decimal(12,2)) <= 0"))
    return stats.joined_ids(bad.select(F.col("id_pedido").cast("bigint").alias("id_pedido")), "id_pedido")


@query("a22_units_by_dish", """
    SELECT l_partkey AS id_plato, CAST(sum(l_quantity) AS BIGINT) AS unidades FROM lineitem GROUP BY 1""")
def _(t: Tables):
    units = b.lines(t).groupBy("id_plato").agg(F.sum("cantidad").alias("unidades"))
    return units.orderBy(F.desc("unidades"), "id_plato")


@query("a23_sum_if", b.sql("sales", """
    SELECT categoria, coalesce(sum(importe_neto) FILTER (WHERE origen = 'CSV externo'), 0)::DOUBLE AS ventas_app FROM sales GROUP BY 1"""))
def _(t: Tables):
    return stats.sum_if(b.by_dish(t, "origen"), ["categoria"], F.col("origen") == EXTERNAL, "importe_neto", "ventas_app")


@query("a24_share_of_groups", b.sql("sales", """
    SELECT avg((n >= 3)::INT) * 100 AS pct FROM (SELECT nro_pedido, count(*) AS n FROM lines GROUP BY 1)"""))
def _(t: Tables):
    per_order = b.lines(t).groupBy("ref").agg(F.count(F.lit(1)).alias("n"))
    return per_order.agg((F.avg((F.col("n") >= 3).cast("int")) * 100).alias("pct"))


@query("a25_distinct_refs", "SELECT count(*) AS filas, count(DISTINCT (l_orderkey, l_linenumber)) AS claves FROM lineitem")
def _(t: Tables):
    per_key = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("filas"), F.count(F.lit(1)).alias("claves"))


COUNTED = ["customer", "supplier", "part", "orders", "lineitem", "events"]


@query("a26_table_counts", " UNION ALL ".join(f"SELECT '{n}' AS tabla, count(*) AS filas FROM {n}" for n in COUNTED))
def _(t: Tables):
    return stats.table_counts({name: getattr(t, name) for name in COUNTED})


BENCH_SQL = """SELECT nombre_plato, l_returnflag, sum(importe_neto)::DOUBLE AS ventas, CAST(sum(cantidad) AS BIGINT) AS unidades
    FROM sales GROUP BY 1, 2"""


@query("a27_bench_agg", b.sql("sales", BENCH_SQL))
def _(t: Tables):
    return b.in_units(volume.bench_agg(b.lines(t), b.dishes(t), "id_plato", "nombre_plato", "l_returnflag", "importe_neto", "cantidad"), "ventas")


@query("a28_month_channel", b.sql("sales", "SELECT anio_mes, canal, sum(importe_neto)::DOUBLE AS ventas FROM sales GROUP BY 1, 2"))
def _(t: Tables):
    return olap.sum_by(b.by_order(t), ["anio_mes", "canal"], NET).orderBy("anio_mes", "canal")


@query("a29_sales_by_dish", b.sql("sales", "SELECT nombre_plato, sum(importe_neto)::DOUBLE AS ventas FROM sales GROUP BY 1"))
def _(t: Tables):
    return olap.sum_by(b.by_dish(t), ["nombre_plato"], NET).orderBy(F.desc("ventas"), "nombre_plato")


@query("a30_by_category", b.sql("sales", "SELECT categoria, sum(importe_neto)::DOUBLE AS ventas FROM sales GROUP BY 1"))
def _(t: Tables):
    return olap.sum_by(b.by_dish(t), ["categoria"], NET).orderBy("ventas")


@query("a30_by_month", b.sql("sales", "SELECT anio_mes, sum(importe_neto)::DOUBLE AS ventas, sum(margen_bruto)::DOUBLE AS margen FROM sales GROUP BY 1"))
def _(t: Tables):
    return olap.sum_by(b.by_order(t, dish=True), ["anio_mes"], MARGIN).orderBy("anio_mes")


@query("a30_by_weekday", b.sql("fact_ventas dim_fecha", """
    SELECT dia_semana, dia_semana_num, sum(importe_neto)::DOUBLE AS ventas FROM fact_ventas JOIN dim_fecha USING (sk_fecha) WHERE sk_canal <= 3 GROUP BY 1, 2"""))
def _(t: Tables):
    tables = b.star(t)
    per_day = tables["fact_ventas"].filter("sk_canal <= 3").groupBy("sk_fecha").agg(F.sum("importe_neto").alias("importe_neto"))
    dates = tables["dim_fecha"].select("sk_fecha", "dia_semana", "dia_semana_num")
    return olap.sum_by(per_day.join(dates, "sk_fecha"), ["dia_semana", "dia_semana_num"], NET).orderBy("dia_semana_num")


@query("a30_channel_share", b.sql("sales", """
    SELECT canal, sum(importe_neto)::DOUBLE AS ventas, sum(importe_neto)::DOUBLE / sum(sum(importe_neto)) OVER ()::DOUBLE AS cuota FROM sales GROUP BY 1"""))
def _(t: Tables):
    return windows.share_within(olap.sum_by(b.by_order(t), ["canal"], NET), "ventas", [], "cuota")
