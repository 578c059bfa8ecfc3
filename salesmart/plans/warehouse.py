"""Star build: D1-D10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import warehouse
from ..sources.schemas import FACT_COLUMNS, STAR, fields
from ..sources.tables import Tables
from . import bindings as b
from .quality import ACCEPTED, LINES
from .registry import query


def _typed(table: str) -> str:
    """All columns of a star table; amounts as DOUBLE."""
    return ", ".join(f"{c}::DOUBLE AS {c}" if t.startswith("decimal") else c for c, t in fields(STAR[table]))


@query("d01_dim_fecha", b.sql("dim_fecha", f"SELECT {_typed('dim_fecha')} FROM dim_fecha"))
def _(t: Tables):
    return warehouse.build_dim_date(t.spark, *b.calendar_range(t), b.holidays(t))


@query("d02_dim_cliente", b.sql("dim_cliente", f"SELECT {_typed('dim_cliente')} FROM dim_cliente"))
def _(t: Tables):
    return warehouse.build_dim_customer(b.clientes(t), b.AS_OF, b.SALT)


@query("d03_dim_plato", b.sql("dim_plato", f"SELECT {_typed('dim_plato')} FROM dim_plato"))
def _(t: Tables):
    return warehouse.build_dim_dish(b.platos(t))


@query("d04_dim_empleado", b.sql("dim_empleado", f"SELECT {_typed('dim_empleado')} FROM dim_empleado"))
def _(t: Tables):
    return warehouse.build_dim_employee(b.empleados(t))


def _small(table: str, key: str) -> None:
    """A small dimension with the fact lines of each of its members."""
    @query(f"d05_{table}", b.sql(f"{table} fact_ventas", f"""
        SELECT d.*, coalesce(n, 0) AS lineas FROM {table} d LEFT JOIN (SELECT {key}, count(*) AS n FROM fact_ventas GROUP BY 1) USING ({key})"""))
    def _(t: Tables):
        per_member = b.star(t)["fact_ventas"].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        dim = warehouse.build_small_dims(t.spark)[table]
        return dim.join(per_member, key, "left").withColumn("lineas", F.coalesce("n", F.lit(0))).drop("n")


_small("dim_metodo_pago", "sk_pago")
_small("dim_canal", "sk_canal")
_small("dim_turno", "sk_turno")

BRANCH = [c for c in FACT_COLUMNS if c not in ("sk_venta", "margen_bruto")]
AMOUNTS = {c for c, kind in fields(STAR["fact_ventas"]) if kind.startswith("decimal")}
MONEY = sorted(AMOUNTS - {"calificacion"})
BRANCH_SQL = ", ".join(f"{c}::DOUBLE AS {c}" if c in AMOUNTS else c for c in BRANCH)


@query("d06_fact_internal", b.sql("fact_internal", f"SELECT {BRANCH_SQL} FROM fact_internal"))
def _(t: Tables):
    rows = b.in_units(warehouse.build_fact_internal(b.detalle(t), b.pedidos(t), b.star(t)), *MONEY)
    missing = {"tiempo_entrega_min": F.lit(None).cast("int"), "calificacion": F.lit(None).cast("double")}
    return rows.withColumns(missing).select(*BRANCH)


@query("d07_fact_external", b.sql("fact_external", f"SELECT {BRANCH_SQL} FROM fact_external"))
def _(t: Tables):
    feed = warehouse.clean_feed(b.feed(t), b.platos(t), b.FIRST)
    return b.in_units(warehouse.build_fact_external(feed, b.star(t)), *MONEY).select(*BRANCH)


@query("d08_fact_ventas", b.sql("fact_ventas", f"SELECT {_typed('fact_ventas')} FROM fact_ventas"))
def _(t: Tables):
    return b.star(t)["fact_ventas"]


@query("d09_clean_feed", b.sql("clean_feed", """
    SELECT order_ref, fecha, plataforma, nombre_plato, id_plato, cantidad, precio_bruto::DOUBLE AS precio_bruto, precio_imputado FROM clean_feed"""))
def _(t: Tables):
    return warehouse.clean_feed(b.feed(t), b.platos(t), b.FIRST).select(
        "order_ref", "fecha", "plataforma", "nombre_plato", "id_plato", "cantidad", "precio_bruto", "precio_imputado")


@query("d10_star_report", b.sql(" ".join(STAR), " UNION ALL ".join(
    f"SELECT 'filas {n}' AS medida, count(*)::DOUBLE AS valor FROM {n}" for n in STAR) + """
    UNION ALL SELECT 'ventas netas', sum(importe_neto)::DOUBLE FROM fact_ventas
    UNION ALL SELECT 'dni_hash nulos', (count(*) FILTER (WHERE dni_hash IS NULL))::DOUBLE FROM dim_cliente"""))
def _(t: Tables):
    return warehouse.star_report(b.star(t))


@query("d11_chained_fact", b.sql("stg_pedido stg_detalle stg_cliente dim_plato dim_empleado dim_metodo_pago dim_canal dim_turno", f"""
    WITH {ACCEPTED}, {LINES}, cli AS (
      SELECT 2 + row_number() OVER (ORDER BY id) AS sk_cliente, id FROM (
        SELECT DISTINCT TRY_CAST(id_cliente AS BIGINT) AS id FROM stg_cliente) WHERE id IS NOT NULL AND id <> 9999)
    SELECT 'SQL-' || id_pedido AS nro_pedido, CAST(strftime(fecha_pedido, '%Y%m%d') AS INT) AS sk_fecha, coalesce(cli.sk_cliente, 1) AS sk_cliente,
      sk_plato, sk_empleado, sk_pago, sk_canal, sk_turno, cantidad, subtotal::DOUBLE AS importe_neto
    FROM lin JOIN ok USING (id_pedido) LEFT JOIN cli ON cli.id = id_cliente
      LEFT JOIN dim_plato p ON p.id_plato_nk = id_plato LEFT JOIN dim_empleado e ON e.id_empleado_nk = id_empleado
      LEFT JOIN dim_metodo_pago m USING (metodo_pago) LEFT JOIN dim_canal k ON k.canal = canal_interno
      LEFT JOIN dim_turno u ON u.turno = CASE WHEN CAST(left(hora_pedido, 2) AS INT) < 15 THEN 'Almuerzo (11-15h)'
        WHEN CAST(left(hora_pedido, 2) AS INT) < 18 THEN 'Tarde (15-18h)' ELSE 'Noche (18-22h)' END"""))
def _(t: Tables):
    fact = b.chained_star(t)["fact_ventas"]
    return fact.filter("origen = 'SQL Server'").select(
        "nro_pedido", "sk_fecha", "sk_cliente", "sk_plato", "sk_empleado", "sk_pago", "sk_canal", "sk_turno", "cantidad", "importe_neto")
