"""KPIs: K1-K20, each at its own grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import measures, olap, windows
from ..sources.tables import Tables
from . import bindings as b
from .registry import query

# SQL of every measure over the sales view, straight from its definition.
RULES = {
    "net_sales": "sum(importe_neto)::DOUBLE",
    "gross_sales": "sum(importe_bruto)::DOUBLE",
    "orders": "count(DISTINCT nro_pedido)",
    "avg_ticket": "sum(importe_neto)::DOUBLE / nullif(count(DISTINCT nro_pedido), 0)",
    "gross_margin": "sum(margen_bruto)::DOUBLE",
    "gross_margin_pct": "sum(margen_bruto)::DOUBLE / nullif(sum(importe_neto)::DOUBLE, 0)",
    "commission": "sum(comision_plataforma)::DOUBLE",
    "app_rating": "sum(calificacion)::DOUBLE / nullif(count(calificacion), 0)",
    "delivery_min": "sum(tiempo_entrega_min)::DOUBLE / nullif(count(tiempo_entrega_min), 0)",
    "app_share": "sum(importe_neto) FILTER (WHERE origen = 'CSV externo')::DOUBLE / nullif(sum(importe_neto)::DOUBLE, 0)",
    "identified_customers": "count(DISTINCT id_cliente) FILTER (WHERE es_cliente_identificado = 1)",
    "app_orders": "count(DISTINCT nro_pedido) FILTER (WHERE origen = 'CSV externo')",
    "commission_pct": "sum(comision_plataforma)::DOUBLE / nullif(sum(importe_bruto) FILTER (WHERE origen = 'CSV externo')::DOUBLE, 0)",
    "margin_per_order": "sum(margen_bruto)::DOUBLE / nullif(count(DISTINCT nro_pedido), 0)",
}


LINE_KEYS = {"categoria", "nombre_plato"}
ORDER_KEYS = {"anio", "trimestre", "mes_num", "anio_mes", "canal"}
CUSTOMER_KEYS = {"distrito", "metodo_pago", "tipo_cliente"}
USES_COST = {"gross_margin", "gross_margin_pct", "margin_per_order"}
USES_CUSTOMER = {"identified_customers", "repeat_pct"}


def report(t: Tables, names: list[str], *by: str) -> DataFrame:
    """Measures at a grouping, joining only the dimensions they touch."""
    line_keys = [k for k in by if k in LINE_KEYS]
    rows = b.by_ref(
        t, *line_keys, dish=bool(line_keys or USES_COST & set(names)), order=bool(ORDER_KEYS & set(by)),
        customer=bool(CUSTOMER_KEYS & set(by) or USES_CUSTOMER & set(names)))
    return measures.order_measures(rows, *by, names=names)


def _measure(id_: str, name: str, *by: str) -> None:
    keys = "".join(f"{k}, " for k in by)

    @query(f"{id_}_{name}", b.sql("sales", f"SELECT {keys}{RULES[name]} AS {name} FROM sales GROUP BY ALL"))
    def _(t: Tables):
        return report(t, [name], *by)


def _additive(id_: str, name: str, *by: str) -> None:
    """Measures without distinct counts over dish attributes need no order grouping."""
    keys = "".join(f"{k}, " for k in by)

    @query(f"{id_}_{name}", b.sql("sales", f"SELECT {keys}{RULES[name]} AS {name} FROM sales GROUP BY ALL"))
    def _(t: Tables):
        return measures.measures(b.sales(t, dish=True), *by, names=[name])


_measure("k01", "net_sales", "anio")
_additive("k02", "gross_sales", "categoria")
_measure("k03", "orders", "canal")
_measure("k04", "avg_ticket", "canal")
_measure("k05", "gross_margin", "anio", "trimestre")
_measure("k06", "gross_margin_pct", "canal")
_measure("k07", "commission", "canal")
_additive("k08", "app_rating", "categoria")
_measure("k09", "delivery_min", "distrito")
_additive("k10", "app_share", "categoria")
_measure("k11", "identified_customers", "distrito")
_measure("k16", "app_orders", "metodo_pago")
_measure("k17", "commission_pct", "canal")
_measure("k18", "margin_per_order", "canal")

REPEAT = """
    SELECT distrito, count(*) FILTER (WHERE n >= 2)::DOUBLE / nullif(count(*), 0) AS repeat_pct
    FROM (SELECT distrito, id_cliente, count(DISTINCT nro_pedido) AS n FROM sales WHERE es_cliente_identificado = 1 GROUP BY 1, 2) GROUP BY 1"""


@query("k12_repeat_pct", b.sql("sales", REPEAT))
def _(t: Tables):
    return report(t, ["repeat_pct"], "distrito")


def _yearly(t: Tables):
    yearly = olap.sum_by(b.by_order(t), ["anio", "mes_num"], {"net_sales": "importe_neto"})
    return windows.yoy(yearly, ["anio", "mes_num"], "net_sales")


BASE_SQL = """WITH m AS (SELECT anio, mes_num, sum(importe_neto) AS s FROM sales GROUP BY 1, 2)
    SELECT c.anio, c.mes_num, {0} FROM m c LEFT JOIN m p ON p.anio = c.anio - 1 AND p.mes_num = c.mes_num"""


@query("k13_net_sales_ly", b.sql("sales", BASE_SQL.format("p.s::DOUBLE AS net_sales_ly")))
def _(t: Tables):
    return _yearly(t).select("anio", "mes_num", F.col("net_sales_aa").alias("net_sales_ly"))


@query("k14_growth_pct", b.sql("sales", BASE_SQL.format("(c.s::DOUBLE - p.s::DOUBLE) / nullif(p.s::DOUBLE, 0) AS growth_pct")))
def _(t: Tables):
    return _yearly(t).select("anio", "mes_num", F.col("crecimiento").alias("growth_pct"))


@query("k15_category_share", b.sql("sales", """
    SELECT anio, trimestre, categoria, sum(importe_neto)::DOUBLE / (sum(sum(importe_neto)) OVER (PARTITION BY anio, trimestre))::DOUBLE AS category_share
    FROM sales GROUP BY 1, 2, 3"""))
def _(t: Tables):
    return measures.category_share(b.by_order(t, "categoria", dish=True), "anio", "trimestre").drop("net_sales")


# Every row of the KPI report from its own definition.
KPI_SQL = {
    "K1 Ventas netas (S/)": RULES["net_sales"],
    "K2 Nº de pedidos": RULES["orders"] + "::DOUBLE",
    "K3 Ticket promedio por pedido (S/)": RULES["avg_ticket"],
    "K4 Margen bruto (S/)": RULES["gross_margin"],
    "K5 Margen bruto (%)": RULES["gross_margin_pct"] + " * 100",
    "K6 Clientes identificados": RULES["identified_customers"] + "::DOUBLE",
    "K8 Participación ventas apps delivery (%)": RULES["app_share"] + " * 100",
    "K9 Comisión pagada a plataformas (S/)": RULES["commission"],
    "K10 Calificación promedio apps (1-5)": RULES["app_rating"],
    "K11 Tiempo de entrega promedio apps (min)": RULES["delivery_min"],
}


@query("k19_kpi_table", b.sql("sales", " UNION ALL ".join(
    f"SELECT '{label}' AS kpi, round({rule}, 2) AS valor FROM sales" for label, rule in KPI_SQL.items()) + """
    UNION ALL SELECT 'K7 Tasa de clientes recurrentes (%)', round(count(*) FILTER (WHERE n >= 2)::DOUBLE / count(*) * 100, 2)
    FROM (SELECT id_cliente, count(DISTINCT nro_pedido) AS n FROM sales WHERE es_cliente_identificado = 1 GROUP BY 1)"""))
def _(t: Tables):
    return measures.kpi_table(b.by_ref(t, dish=True, customer=True))


PANEL = ", ".join(f"{RULES[name]} AS {name}" for name in measures.APP_PANEL)


@query("k20_app_panel", b.sql("sales", f"""
    SELECT canal, CAST(grouping(canal) AS INT) AS g_canal, {PANEL} FROM (SELECT * FROM sales WHERE origen = 'CSV externo') GROUP BY ROLLUP (canal)"""))
def _(t: Tables):
    panel = measures.app_panel(b.by_ref(t, dish=True, order=True))
    return panel.withColumn("g_canal", F.col("g_canal").cast("int"))


@query("k_measures_by_category_channel", b.sql("sales", f"""
    SELECT categoria, canal, {', '.join(f'{rule} AS {name}' for name, rule in RULES.items() if name != 'repeat_pct')} FROM sales GROUP BY ALL"""))
def _(t: Tables):
    rows = b.by_ref(t, "categoria", dish=True, order=True, customer=True)
    return measures.order_measures(rows, "categoria", "canal", names=[n for n in measures.MEASURES if n != "repeat_pct"])
