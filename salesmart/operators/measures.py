"""Named KPI measures, computable at any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.money import ratio, units
from . import windows

EXTERNAL = "CSV externo"
INTERNAL = "SQL Server"

_SUMS = {
    "_neto": "importe_neto", "_bruto": "importe_bruto", "_margen": "margen_bruto",
    "_comision": "comision_plataforma", "_neto_app": "_neto_app", "_bruto_app": "_bruto_app",
    "_calif": "calificacion", "_min": "tiempo_entrega_min",
}

# Measures over the per-group totals built by ``totals``.
MEASURES: dict[str, Column | str] = {
    "net_sales": "_neto",
    "gross_sales": "_bruto",
    "orders": "_pedidos",
    "avg_ticket": ("_neto", "_pedidos"),
    "gross_margin": "_margen",
    "gross_margin_pct": ("_margen", "_neto"),
    "commission": "_comision",
    "app_rating": ("_calif", "_n_calif"),
    "delivery_min": ("_min", "_n_min"),
    "app_share": ("_neto_app", "_neto"),
    "identified_customers": "_identificados",
    "repeat_pct": ("_recurrentes", "_identificados"),
    "app_orders": "_pedidos_app",
    "commission_pct": ("_comision", "_bruto_app"),
    "margin_per_order": ("_margen", "_pedidos"),
}


_AMOUNTS = ["_neto", "_bruto", "_margen", "_comision", "_neto_app", "_bruto_app"]
_SUMMED = [*_SUMS, "_n_calif", "_n_min"]
_PER_ORDER = {"_pedidos", "_pedidos_app"}
_PER_CUSTOMER = {"_identificados", "_recurrentes"}


def _needs(names: Sequence[str]) -> set[str]:
    """Totals behind the chosen measures."""
    parts: set[str] = set()
    for name in names:
        rule = MEASURES[name]
        parts.update(rule if isinstance(rule, tuple) else (rule,))
    return parts


def _line_sums(sales: DataFrame) -> tuple[DataFrame, list[Column]]:
    external = F.col("origen") == EXTERNAL
    rows = sales.withColumns({
        "_neto_app": F.when(external, F.col("importe_neto")),
        "_bruto_app": F.when(external, F.col("importe_bruto")),
    })
    sums = [F.sum(c).alias(name) for name, c in _SUMS.items() if c in rows.columns]
    counts = [F.count("calificacion").alias("_n_calif"), F.count("tiempo_entrega_min").alias("_n_min")]
    return rows, [*sums, *counts]


def per_order(sales: DataFrame, *by: str, order: str = "nro_pedido") -> DataFrame:
    """One row per order within each group: sums, counts and, where the rows
    carry it, the order's customer (the same on all its lines)."""
    rows, sums = _line_sums(sales)
    customer = {"id_cliente": "id_cliente", "_ident": "es_cliente_identificado"}
    own = [F.min(c).alias(name) for name, c in customer.items() if c in sales.columns]
    app = F.max((F.col("origen") == EXTERNAL).cast("int")).alias("_app")
    return rows.groupBy(*by, order).agg(*sums, app, *own)


def in_units(df: DataFrame) -> DataFrame:
    """Amounts that came as whole cents turn into decimals."""
    whole = [c for c in _AMOUNTS if c in df.columns and isinstance(df.schema[c].dataType, T.LongType)]
    return df.withColumns({c: units(F.col(c)) for c in whole}) if whole else df


def _sum_again(df: DataFrame) -> list[Column]:
    return [F.sum(c).alias(c) for c in [*_SUMMED, "_pedidos", "_pedidos_app"] if c in df.columns]


def totals(orders: DataFrame, *by: str, needs: set[str]) -> DataFrame:
    """Group totals from one row per order and group.

    Customer counts go over one row per customer first, so distinct counts are
    plain counts and every step shrinks the rows before its shuffle.
    """
    rows = orders.withColumns({"_pedidos": F.lit(1), "_pedidos_app": F.col("_app")})
    if not needs & _PER_CUSTOMER:
        return in_units(rows.groupBy(*by).agg(*_sum_again(rows)))
    customers = in_units(rows.groupBy(*by, "id_cliente", "_ident").agg(*_sum_again(rows)))
    known = F.col("_ident") == 1
    return customers.groupBy(*by).agg(
        *_sum_again(customers),
        F.count_if(known).alias("_identificados"),
        F.count_if(known & (F.col("_pedidos") >= 2)).alias("_recurrentes"),
    )


def _published(names: Sequence[str]) -> list[Column]:
    columns = []
    for name in names:
        rule = MEASURES[name]
        c = ratio(F.col(rule[0]), F.col(rule[1])) if isinstance(rule, tuple) else F.col(rule)
        columns.append(c.alias(name))
    return columns


def order_measures(orders: DataFrame, *by: str, names: Sequence[str] | None = None) -> DataFrame:
    """``measures`` over rows already summed by ``per_order`` with keys out of ``by``."""
    names = names or list(MEASURES)
    return totals(orders, *by, needs=_needs(names)).select(*by, *_published(names))


def measures(sales: DataFrame, *by: str, names: Sequence[str] | None = None,
             order: str = "nro_pedido") -> DataFrame:
    """The chosen measures (all by default) per group, or over everything.

    ``order`` is the column that tells orders apart.  Amounts may be decimals or
    whole cents.  Measures without distinct counts never group by order.
    """
    names = names or list(MEASURES)
    if _needs(names) & (_PER_ORDER | _PER_CUSTOMER):
        return order_measures(per_order(sales, *by, order=order), *by, names=names)
    rows, sums = _line_sums(sales)
    return in_units(rows.groupBy(*by).agg(*sums)).select(*by, *_published(names))


# Labels and order of the KPI report.
KPI_ROWS = [
    ("K1 Ventas netas (S/)", "net_sales", 1),
    ("K2 Nº de pedidos", "orders", 1),
    ("K3 Ticket promedio por pedido (S/)", "avg_ticket", 1),
    ("K4 Margen bruto (S/)", "gross_margin", 1),
    ("K5 Margen bruto (%)", "gross_margin_pct", 100),
    ("K6 Clientes identificados", "identified_customers", 1),
    ("K7 Tasa de clientes recurrentes (%)", "repeat_pct", 100),
    ("K8 Participación ventas apps delivery (%)", "app_share", 100),
    ("K9 Comisión pagada a plataformas (S/)", "commission", 1),
    ("K10 Calificación promedio apps (1-5)", "app_rating", 1),
    ("K11 Tiempo de entrega promedio apps (min)", "delivery_min", 1),
]


def kpi_table(orders: DataFrame) -> DataFrame:
    """(kpi, valor) rounded to two digits, from one row per order."""
    wide = order_measures(orders)
    rows = [F.struct(F.lit(label).alias("kpi"),
                     F.round(F.col(name).cast("double") * scale, 2).alias("valor"))
            for label, name, scale in KPI_ROWS]
    return wide.select(F.inline(F.array(*rows)))


APP_PANEL = ["orders", "gross_sales", "commission", "commission_pct", "gross_margin_pct",
             "app_rating", "delivery_min"]


def app_panel(orders: DataFrame) -> DataFrame:
    """App measures per platform plus one total row, from one row per order;
    ``g_canal`` = 1 marks the total."""
    by_channel = totals(orders.filter("_app = 1"), "canal", needs=_needs(APP_PANEL))
    rolled = by_channel.rollup("canal").agg(*_sum_again(by_channel), F.grouping("canal").alias("g_canal"))
    return rolled.select("canal", "g_canal", *_published(APP_PANEL))


def category_share(sales: DataFrame, *by: str) -> DataFrame:
    """Net sales per category and its share with the other groupings kept."""
    sums = sales.groupBy(*by, "categoria").agg(F.sum("importe_neto").alias("net_sales"))
    return windows.share_within(sums, "net_sales", list(by), "category_share")
