"""OLAP operations: O1-O8."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import calendar
from ..operators import olap, windows
from ..sources.tables import Tables
from . import bindings as b
from .aggregates import pivot_weekday_shift
from .registry import query

NET = {"ventas": "importe_neto"}
BOTH = {"ventas": "importe_neto", "margen": "margen_bruto"}
PATH = olap.HIERARCHIES["fecha"][:3]


def _level(level: str) -> None:
    keys = ", ".join(PATH[:PATH.index(level) + 1])

    @query(f"o01_rollup_{level}", b.sql("sales", f"""
        SELECT {keys}, sum(importe_neto)::DOUBLE AS ventas, sum(margen_bruto)::DOUBLE AS margen FROM sales GROUP BY ALL"""))
    def _(t: Tables):
        return olap.rollup_levels(b.by_order(t, dish=True), PATH, BOTH)[level]


for _name in PATH:
    _level(_name)


@query("o02_drill_category", b.sql("sales", """
    SELECT categoria, sum(importe_neto)::DOUBLE AS ventas, CAST(sum(cantidad) AS BIGINT) AS unidades FROM sales GROUP BY 1"""))
def _(t: Tables):
    return olap.drill_down(b.by_dish(t), olap.HIERARCHIES["plato"], {}, {"ventas": "importe_neto", "unidades": "cantidad"})


@query("o02_drill_dishes", b.sql("sales", """
    SELECT nombre_plato, sum(importe_neto)::DOUBLE AS ventas, CAST(sum(cantidad) AS BIGINT) AS unidades, sum(margen_bruto)::DOUBLE AS margen
    FROM sales WHERE categoria = 'ECONOMY' GROUP BY 1"""))
def _(t: Tables):
    return olap.drill_down(b.by_dish(t), olap.HIERARCHIES["plato"], {"categoria": "ECONOMY"},
                           {"ventas": "importe_neto", "unidades": "cantidad", "margen": "margen_bruto"})


@query("o03_slice_channel", b.sql("sales", """
    SELECT anio_mes, sum(importe_bruto)::DOUBLE AS ventas_brutas, sum(comision_plataforma)::DOUBLE AS comision, sum(importe_neto)::DOUBLE AS neto
    FROM sales WHERE canal = '2-HIGH' GROUP BY 1"""))
def _(t: Tables):
    sliced = b.by_order(t, orders=olap.slice_(b.heads(t), "canal", "2-HIGH"))
    return olap.sum_by(sliced, ["anio_mes"], {"ventas_brutas": "importe_bruto", "comision": "comision_plataforma", "neto": "importe_neto"})


CATEGORIES, PAYMENTS = ["ECONOMY", "SMALL"], ["FURNITURE", "MACHINERY"]
DICED = "sales WHERE anio = 1996 AND trimestre = 1 AND categoria IN ('ECONOMY','SMALL') AND metodo_pago IN ('FURNITURE','MACHINERY')"


def _diced(t: Tables) -> DataFrame:
    payers = b.people(t).select("id_cliente", "metodo_pago").filter(F.col("metodo_pago").isin(*PAYMENTS))
    orders = olap.in_quarter(b.heads(t).join(payers, "id_cliente"), 1996, 1)
    return olap.dice(b.by_order(t, "categoria", dish=True, orders=orders), 1996, 1, CATEGORIES, PAYMENTS)


@query("o04_dice_flat", b.sql("sales", f"SELECT categoria, metodo_pago, sum(importe_neto)::DOUBLE AS ventas_netas FROM {DICED} GROUP BY 1, 2"))
def _(t: Tables):
    return olap.sum_by(_diced(t), ["categoria", "metodo_pago"], {"ventas_netas": "importe_neto"})


@query("o04_dice_margins", b.sql("sales", f"""
    SELECT CASE WHEN grouping(categoria) = 1 THEN 'Total' ELSE categoria END AS categoria,
      round(sum(importe_neto) FILTER (WHERE metodo_pago = 'FURNITURE')::DOUBLE, 2) AS "FURNITURE",
      round(sum(importe_neto) FILTER (WHERE metodo_pago = 'MACHINERY')::DOUBLE, 2) AS "MACHINERY",
      round(sum(importe_neto)::DOUBLE, 2) AS "Total" FROM {DICED} GROUP BY ROLLUP (categoria)"""))
def _(t: Tables):
    return olap.pivot_margins(_diced(t), "categoria", "metodo_pago", PAYMENTS, "importe_neto")


# Store sales only: weekday and shift come from the star.
@query("o05_pivot_weekday_shift", b.sql("star_view", """
    SELECT dia_semana, sum(importe_neto) FILTER (WHERE turno = 'Almuerzo (11-15h)')::DOUBLE AS "Almuerzo (11-15h)",
      sum(importe_neto) FILTER (WHERE turno = 'Tarde (15-18h)')::DOUBLE AS "Tarde (15-18h)",
      sum(importe_neto) FILTER (WHERE turno = 'Noche (18-22h)')::DOUBLE AS "Noche (18-22h)"
    FROM star_view WHERE origen = 'SQL Server' GROUP BY 1"""))
def _(t: Tables):
    tables = b.star(t)
    store = tables["fact_ventas"].filter("origen = 'SQL Server'").groupBy("sk_fecha", "sk_turno").agg(F.sum("importe_neto").alias("importe_neto"))
    rows = store.join(tables["dim_fecha"].select("sk_fecha", "dia_semana_num", "dia_semana"), "sk_fecha").join(tables["dim_turno"], "sk_turno")
    return pivot_weekday_shift(rows)


@query("o07_monthly_line", b.sql("sales", "SELECT anio_mes, sum(importe_neto)::DOUBLE AS ventas, sum(margen_bruto)::DOUBLE AS margen FROM sales GROUP BY 1"))
def _(t: Tables):
    return dashboard_feed(t, "mes")


@query("o07_top_dishes", b.sql("sales", "SELECT nombre_plato, sum(importe_neto)::DOUBLE AS ventas FROM sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8"))
def _(t: Tables):
    return dashboard_feed(t, "top")


@query("o07_channel_ring", b.sql("sales", """
    SELECT canal, sum(importe_neto)::DOUBLE AS ventas, sum(importe_neto)::DOUBLE / (sum(sum(importe_neto)) OVER ())::DOUBLE AS cuota FROM sales GROUP BY 1"""))
def _(t: Tables):
    return dashboard_feed(t, "canal")


@query("o07_heat_matrix", b.sql("star_view", """
    SELECT dia_semana, turno, sum(importe_neto)::DOUBLE AS ventas FROM star_view WHERE turno <> 'No registrado' GROUP BY 1, 2"""))
def _(t: Tables):
    return dashboard_feed(t, "calor")


@query("o07_category_bars", b.sql("sales", "SELECT categoria, sum(importe_neto)::DOUBLE AS ventas FROM sales GROUP BY 1"))
def _(t: Tables):
    return dashboard_feed(t, "categoria")


def _heat(t: Tables) -> DataFrame:
    tables = b.star(t)
    cells = tables["fact_ventas"].groupBy("sk_fecha", "sk_turno").agg(F.sum("importe_neto").alias("importe_neto"))
    days = tables["dim_fecha"].select("sk_fecha", "dia_semana")
    shifts = tables["dim_turno"].filter(F.col("turno").isin(*calendar.SHIFTS))
    return olap.sum_by(cells.join(days, "sk_fecha").join(shifts, "sk_turno"), ["dia_semana", "turno"], NET)


# The data behind the summary page: month line, top dishes, channel ring, heat map, category bars.
DASHBOARD = {
    "mes": lambda t: olap.sum_by(b.by_order(t, dish=True), ["anio_mes"], BOTH).orderBy("anio_mes"),
    "top": lambda t: windows.top_k(olap.sum_by(b.by_dish(t), ["nombre_plato"], NET), "ventas", 8, ["nombre_plato"]),
    "canal": lambda t: windows.share_within(olap.sum_by(b.by_order(t), ["canal"], NET), "ventas", [], "cuota"),
    "calor": _heat,
    "categoria": lambda t: olap.sum_by(b.by_dish(t), ["categoria"], NET).orderBy("ventas"),
}


def dashboard_feed(t: Tables, name: str) -> DataFrame:
    """One feed; only what it reads is built."""
    return DASHBOARD[name](t)


@query("o08_drill_path", b.sql("sales", """
    SELECT anio, trimestre, anio_mes, fecha, sum(importe_neto)::DOUBLE AS ventas FROM sales GROUP BY 1, 2, 3, 4"""))
def _(t: Tables):
    return olap.sum_by(b.by_order(t), olap.HIERARCHIES["fecha"], NET)
