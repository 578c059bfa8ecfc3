"""How the shared test tables stand for the mart's inputs.

Input columns are given as SQL expressions valid in Spark and DuckDB, so both
sides read the same (partly dirtied) inputs; everything computed from them is
written separately on each side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar, money
from ..operators import joins, measures, quality, warehouse
from ..operators.measures import EXTERNAL, INTERNAL
from ..session import once, stage
from ..sources import schemas
from ..sources.tables import Tables

AS_OF = dt.date(2001, 8, 1)
LOAD_DATE = dt.date(2026, 9, 28)
SALT = "mart-salt"

SPARK = {"dmy": "date_format({0}, 'dd/MM/yyyy')", "k": "CAST(get_json_object(props, '$.k') AS INT)",
         "div": "{0} div {1}", "words": "split({0}, ' ')", "sellers": "n_sellers", "dishes": "n_dishes"}
DUCK = {"dmy": "strftime({0}, '%d/%m/%Y')", "k": "CAST(json_extract_string(props, '$.k') AS INT)",
        "div": "{0} // {1}", "words": "string_split({0}, ' ')",
        "sellers": "(SELECT count(*) FROM supplier)", "dishes": "(SELECT count(*) FROM part)"}


def _dialect(d: dict[str, str]):
    return lambda name, *args: d[name].format(*args)


def _money(c: str) -> str:
    return f"CAST({c} AS DECIMAL(12,2))"


# ---------------------------------------------------------------- clean OLTP tables

def pedidos_cols(f) -> dict[str, str]:
    return {
        "id_pedido": "o_orderkey",
        "fecha_pedido": "CAST(o_orderdate AS DATE)",
        "hora_pedido": "CAST(11 + o_orderkey % 11 AS STRING) || ':30'",
        "id_cliente": "CASE WHEN o_orderkey % 13 = 0 THEN 9999 ELSE o_custkey + 10000 END",
        "id_empleado": f"1 + o_custkey % {f('sellers')}",
        "canal_interno": "CASE o_orderkey % 3 WHEN 0 THEN 'Salón' WHEN 1 THEN 'Para llevar' ELSE 'Delivery propio' END",
        "metodo_pago": "CASE o_orderkey % 4 WHEN 0 THEN 'Efectivo' WHEN 1 THEN 'Yape' WHEN 2 THEN 'Plin' ELSE 'Tarjeta' END",
        "monto_total": _money("o_totalprice"),
        "fecha_imputada": "0",
    }


def detalle_cols(f) -> dict[str, str]:
    cents = "CAST(round(l_extendedprice * 100) AS BIGINT)"
    return {
        "id_detalle": "l_orderkey * 10 + l_linenumber",
        "id_pedido": "l_orderkey",
        "id_plato": "l_partkey",
        "cantidad": "CAST(l_quantity AS INT)",
        "precio_unitario": f"CAST(CAST({f('div', cents, 'CAST(l_quantity AS INT)')} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2))",
        "subtotal": _money("l_extendedprice"),
    }


def clientes_cols(f) -> dict[str, str]:
    return {
        "id_cliente": "c_custkey + 10000",
        "dni": "CASE WHEN c_custkey % 50 = 3 THEN NULL ELSE right(c_name, 8) END",
        "nombre": "'Cliente'",
        "apellido": "right(c_name, 9)",
        "email": "CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE lower(right(c_name, 5)) || '@mail.example' END",
        "telefono": "'9' || right(c_name, 8)",
        "distrito": "'Distrito ' || CAST(c_nationkey AS STRING)",
        "tipo_cliente": "CASE c_nationkey % 3 WHEN 0 THEN 'Nuevo' WHEN 1 THEN 'Frecuente' ELSE 'Corporativo' END",
        "fecha_registro": "CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS DATE)",
    }


def empleados_cols(f) -> dict[str, str]:
    return {
        "id_empleado": "s_suppkey + 1",
        "dni_empleado": "CAST(s_suppkey * 7919 + 1000 AS STRING)",
        "nombre": "'Empleado'",
        "apellido": "right(s_name, 9)",
        "cargo": "CASE s_nationkey % 7 WHEN 0 THEN 'Administrador' WHEN 1 THEN 'Cajero' WHEN 2 THEN 'Mozo' "
                 "WHEN 3 THEN 'Vendedor' WHEN 4 THEN 'Cocinero' WHEN 5 THEN 'Ayudante' ELSE 'Delivery' END",
        "salario_mensual": "CASE WHEN s_suppkey % 9 = 4 THEN NULL ELSE CAST(s_acctbal AS DECIMAL(10,2)) END",
    }


def platos_cols(f) -> dict[str, str]:
    return {
        "id_plato": "p_partkey",
        "nombre_plato": "p_name || ' ' || CAST(p_partkey AS STRING)",
        "categoria": "p_type",
        "precio_base": "CAST(p_size + p_partkey % 4 * 0.25 AS DECIMAL(12,2))",
        "costo_estimado": "CAST(p_size * 0.35 AS DECIMAL(12,2))",
    }


def feed_cols(f) -> dict[str, str]:
    """Raw delivery feed from purchase events, joined to the dish they name (alias p)."""
    name = "p.nombre_plato"
    return {
        "order_ref": "'EXT-' || CAST(event_id AS STRING)",
        "fecha_iso": "CAST(CAST(ts AS DATE) AS STRING)",
        "plataforma": "CASE WHEN user_id % 2 = 0 THEN 'PedidosYa' ELSE 'Rappi' END",
        "plato": f"CASE user_id % 4 WHEN 0 THEN upper({name}) WHEN 1 THEN '  ' || {name} || ' ' "
                 f"WHEN 2 THEN replace(replace({name}, 'e', 'é'), 'u', 'Ü') ELSE {name} END",
        "cantidad": "CAST(1 + event_id % 4 AS INT)",
        "precio_bruto": "CASE WHEN event_id % 40 = 0 THEN NULL ELSE CAST(value AS DECIMAL(12,2)) END",
        "comision_pct": f"18 + {f('k')} % 8",
        "distrito_entrega": "'Distrito ' || CAST(user_id % 25 AS STRING)",
        "tiempo_entrega_min": "CAST(12 + event_id % 69 AS INT)",
        "calificacion": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(1 + event_id % 5 AS DECIMAL(2,1)) END",
        "fila": "event_id",
    }


def resenas_cols(f) -> dict[str, str]:
    """Review documents from events (alias e) and the words of a dish name (alias p)."""
    return {
        "_id": "event_id",
        "plato": "'Brand#' || CAST(1 + user_id % 25 AS STRING)",
        "puntuacion": f"1 + {f('k')} % 5",
        "fuente": "event_type",
        "fecha": "CAST(ts AS DATE)",
        "id_cliente": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END",
        "etiquetas": f"CASE WHEN event_id % 6 = 0 THEN NULL ELSE {f('words', 'p_name')} END",
        "respuesta_local": "CASE WHEN event_id % 3 = 0 THEN 'gracias' ELSE NULL END",
        "util_votos": "CAST(event_id % 10 AS INT)",
        "acompanantes": "CASE WHEN event_id % 2 = 0 THEN CAST(user_id % 4 AS INT) ELSE NULL END",
        "ocasion": "CASE WHEN event_id % 2 = 0 THEN CASE event_id % 8 WHEN 0 THEN 'Cumpleaños' "
                   "WHEN 2 THEN 'Familia' ELSE 'Trabajo' END ELSE NULL END",
    }


# ---------------------------------------------------------------- dirty staging tables

def stg_pedido_cols(f) -> dict[str, str]:
    amount = f"CAST({_money('o_totalprice')} AS STRING)"
    return {
        "id_pedido": "CAST(o_orderkey AS STRING)",
        "fecha_pedido": f"CASE WHEN o_orderkey % 150 = 0 THEN 'Ayer' WHEN o_orderkey % 150 = 75 THEN 'No se sabe' "
                        f"ELSE {f('dmy', 'o_orderdate')} END",
        "hora_pedido": "CAST(11 + o_orderkey % 11 AS STRING) || ':30'",
        "id_cliente": "CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 113 = 1 THEN 'abc' ELSE CAST(o_custkey AS STRING) END",
        "id_empleado": f"CAST(1 + o_custkey % {f('sellers')} AS STRING)",
        "canal_interno": "CASE o_orderkey % 3 WHEN 0 THEN 'Salón' WHEN 1 THEN 'Para llevar' ELSE 'Delivery propio' END",
        "metodo_pago": "CASE o_orderkey % 4 WHEN 0 THEN 'Efectivo' WHEN 1 THEN 'Yape' WHEN 2 THEN 'Plin' ELSE 'Tarjeta' END",
        "monto_total": f"CASE WHEN o_orderkey % 200 = 0 THEN '-' || {amount} WHEN o_orderkey % 200 = 100 THEN '0' "
                       f"WHEN o_orderkey % 333 = 5 THEN 'n/a' ELSE {amount} END",
        "fila": "o_orderkey",
    }


def stg_detalle_cols(f) -> dict[str, str]:
    return {name: f"CAST({expr} AS STRING)" for name, expr in detalle_cols(f).items()}


def stg_cliente_cols(f) -> dict[str, str]:
    return {
        "id_cliente": "CASE WHEN c_custkey % 500 = 7 THEN 'X' || CAST(c_custkey AS STRING) ELSE CAST(c_custkey AS STRING) END",
        "dni": "CASE WHEN c_custkey % 50 = 3 THEN right(c_name, 7) WHEN c_custkey % 50 = 9 THEN 'A' || right(c_name, 7) "
               "ELSE right(c_name, 8) END",
        "nombre": "'Cliente'",
        "apellido": "right(c_name, 9)",
        "distrito": "'Distrito ' || CAST(c_nationkey AS STRING)",
        "tipo_cliente": "CASE c_nationkey % 3 WHEN 0 THEN 'Nuevo' WHEN 1 THEN 'Frecuente' ELSE 'Corporativo' END",
        "fecha_registro": f"CASE WHEN c_custkey % 70 = 1 THEN 'sin fecha' ELSE {f('dmy', f_date())} END",
        "email": "CASE WHEN c_custkey % 33 = 0 THEN '' ELSE lower(right(c_name, 5)) || '@mail.example' END",
        "telefono": "CASE WHEN c_custkey % 20 = 0 THEN '' ELSE '9' || right(c_name, 8) END",
        "fila": "c_custkey",
    }


def f_date() -> str:
    return "CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS DATE)"


# ---------------------------------------------------------------- Spark side

_SPARK = _dialect(SPARK)
_DUCK = _dialect(DUCK)


def _select(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in cols.items()])


def _with_count(df: DataFrame, of: DataFrame, name: str) -> DataFrame:
    """``df`` with the number of rows of another table, a scalar subquery."""
    return df.withColumn(name, of.agg(F.count(F.lit(1))).scalar())


def pedidos(t: Tables) -> DataFrame:
    return _select(_with_count(t.orders, t.supplier, "n_sellers"), pedidos_cols(_SPARK))


def detalle(t: Tables) -> DataFrame:
    return _select(t.lineitem, detalle_cols(_SPARK))


def detalle_cents(t: Tables) -> DataFrame:
    """``detalle`` with its amounts as whole cents."""
    cents = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
    return _select(t.lineitem, detalle_cols(_SPARK) | {
        "precio_unitario": f"{cents} div CAST(l_quantity AS INT)", "subtotal": cents})


def clientes(t: Tables) -> DataFrame:
    return _select(t.customer, clientes_cols(_SPARK))


def empleados(t: Tables) -> DataFrame:
    return _select(t.supplier, empleados_cols(_SPARK))


def platos(t: Tables) -> DataFrame:
    return _select(t.part, platos_cols(_SPARK))


def _repeat(df: DataFrame, every: int, **changes: str) -> DataFrame:
    """Rows whose ``fila`` is a multiple of ``every`` come again, later and changed."""
    again = df.filter(f"fila % {every} = 0").withColumns({c: F.expr(e) for c, e in changes.items()})
    return df.withColumn("copia", F.lit(1)).unionByName(again.withColumn("copia", F.lit(2)))


def _with_dish_key(events: DataFrame, t: Tables) -> DataFrame:
    """Events with the dish they name: keys run from 0, so every dish of the table can be named."""
    return _with_count(events, t.part, "n_dishes").withColumn("dish_key", F.expr(DISH_KEY.format(_SPARK("dishes")))).alias("e")


DISH_KEY = "(event_id * 7) % {0}"


def feed(t: Tables) -> DataFrame:
    """Raw delivery feed with repeated refs; a repeat has lost its price."""
    bought = _with_dish_key(t.events.filter("event_type = 'purchase'"), t)
    named = bought.join(platos(t).alias("p"), F.expr("p.id_plato = dish_key"))
    return _repeat(_select(named, feed_cols(_SPARK)), 91, precio_bruto="CAST(NULL AS DECIMAL(12,2))")


def resenas(t: Tables) -> DataFrame:
    named = _with_dish_key(t.events, t).join(t.part.alias("p"), F.expr("p.p_partkey = dish_key"))
    flat = _select(named, resenas_cols(_SPARK))
    visit = F.when(F.col("ocasion").isNotNull(), F.struct("acompanantes", "ocasion"))
    return flat.withColumn("visita", visit).drop("acompanantes", "ocasion")


def stg_pedido(t: Tables) -> DataFrame:
    """Staged orders; every 97th comes twice, the repeat with another amount."""
    return _repeat(_select(_with_count(t.orders, t.supplier, "n_sellers"), stg_pedido_cols(_SPARK)), 97, monto_total="'1.00'")


def stg_detalle(t: Tables) -> DataFrame:
    return _select(t.lineitem, stg_detalle_cols(_SPARK))


def stg_cliente(t: Tables) -> DataFrame:
    return _repeat(_select(t.customer, stg_cliente_cols(_SPARK)), 41, email="'otro@mail.example'")


# The file position decides which repeat is first.
FIRST = ["copia"]


def calendar_range(t: Tables) -> tuple[dt.date, dt.date]:
    """Whole years from the first to the last date of orders, feed and load."""
    days = t.orders.selectExpr("CAST(o_orderdate AS DATE) AS d").union(t.events.selectExpr("CAST(ts AS DATE) AS d"))
    row = days.agg(F.min("d").alias("a"), F.max("d").alias("b")).first()
    known = [d for d in (row["a"], row["b"], LOAD_DATE) if d]
    return dt.date(min(known).year, 1, 1), dt.date(max(known).year, 12, 31)


def holidays(t: Tables) -> DataFrame:
    """Fixed days and the two before Easter, for every year of the calendar."""
    first, last = calendar_range(t)
    years = t.spark.range(first.year, last.year + 1).selectExpr("CAST(id AS INT) AS anio").withColumn("pascua", F.expr(EASTER.format("date_add")))
    fixed = F.array(*[F.struct(F.make_date(F.col("anio"), F.lit(m), F.lit(d)).alias("fecha"), F.lit(n).alias("feriado")) for m, d, n in HOLIDAYS])
    moved = F.array(*[F.struct(F.date_sub("pascua", k).alias("fecha"), F.lit(n).alias("feriado")) for k, n in BEFORE_EASTER])
    return years.select(F.inline(F.concat(fixed, moved)))


# Public holidays that fall on the same date every year, and those some days before Easter.
HOLIDAYS = [(1, 1, "Año Nuevo"), (5, 1, "Día del Trabajo"), (6, 7, "Batalla de Arica"),
            (6, 29, "San Pedro y San Pablo"), (7, 23, "Día de la Fuerza Aérea"), (7, 28, "Fiestas Patrias"),
            (7, 29, "Fiestas Patrias"), (8, 6, "Batalla de Junín"), (8, 30, "Santa Rosa de Lima"),
            (10, 8, "Combate de Angamos"), (11, 1, "Todos los Santos"), (12, 8, "Inmaculada Concepción"),
            (12, 9, "Batalla de Ayacucho"), (12, 25, "Navidad")]
BEFORE_EASTER = [(3, "Jueves Santo"), (2, "Viernes Santo")]

# Easter by Gauss' rule for 1900-2099: days after 22 March, a week less in its two exceptions.
_D = "((19 * (anio % 19) + 24) % 30)"
_E = f"((2 * (anio % 4) + 4 * (anio % 7) + 6 * {_D} + 5) % 7)"
EASTER = (f"{{0}}(make_date(anio, 3, 22), CAST({_D} + {_E} - CASE WHEN {_E} = 6 AND ({_D} = 29 OR ({_D} = 28 AND anio % 19 > 10)) "
          "THEN 7 ELSE 0 END AS INT))")


# Sales view of the OLAP queries -------------------------------------------------

def lines(t: Tables) -> DataFrame:
    """Order lines; those with status O stand for the delivery apps.

    Amounts are whole cents (BIGINT); ``ref`` tells orders apart as a number.
    """
    external = F.col("l_linestatus") == "O"
    gross, pct = money.cents(F.col("l_extendedprice")), F.rint(F.col("l_discount") * 100).cast("bigint")
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("id_pedido"), F.col("l_partkey").alias("id_plato"), F.col("l_suppkey").alias("id_empleado"),
        F.when(external, EXTERNAL).otherwise(INTERNAL).alias("origen"),
        F.concat(F.when(external, "APP-").otherwise("SQL-"), F.col("l_orderkey").cast("string")).alias("nro_pedido"),
        (F.col("l_orderkey") * 2 + external.cast("int")).alias("ref"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        gross.alias("importe_bruto"),
        F.when(external, money.half_even_div(gross * pct, 100)).otherwise(F.lit(0)).cast("bigint").alias("comision_plataforma"),
        F.when(external, F.col("l_linenumber")).alias("calificacion"),
        F.when(external, F.rint(F.col("l_tax") * 1000).cast("int")).alias("tiempo_entrega_min"),
        "l_returnflag", "l_linenumber",
    )
    return rows.withColumn("importe_neto", F.col("importe_bruto") - F.col("comision_plataforma"))


def dishes(t: Tables) -> DataFrame:
    """Dishes; the estimated cost is in cents, like the line amounts."""
    price = money.cents(F.col("p_retailprice"))
    return t.part.select(
        F.col("p_partkey").alias("id_plato"), F.col("p_brand").alias("nombre_plato"), F.col("p_type").alias("categoria"),
        money.units(price).alias("precio_base"), money.half_even_div(price * 35, 100).alias("costo_estimado"))


def date_columns(d: Column) -> list[Column]:
    return [d.alias("fecha"), F.year(d).alias("anio"), F.quarter(d).alias("trimestre"),
            F.month(d).alias("mes_num"), calendar.year_month(d).alias("anio_mes")]


def heads(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id_pedido"), F.col("o_custkey").alias("id_cliente"),
        F.col("o_orderpriority").alias("canal"), *date_columns(F.col("o_orderdate").cast("date")))


def people(t: Tables) -> DataFrame:
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("distrito"))
    return t.customer.join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("id_cliente"), "distrito", F.col("c_mktsegment").alias("tipo_cliente"),
        F.col("c_mktsegment").alias("metodo_pago"), (F.col("c_acctbal") > 0).cast("int").alias("es_cliente_identificado"))


def with_dish(df: DataFrame, t: Tables) -> DataFrame:
    """Add dish columns, cost and margin (cents)."""
    cost = F.col("cantidad") * F.col("costo_estimado")
    return df.join(dishes(t), "id_plato").withColumns({
        "costo_total": cost, "margen_bruto": F.col("importe_neto") - cost})


def in_units(df: DataFrame, *columns: str) -> DataFrame:
    """Cents to amounts."""
    return df.withColumns({c: money.units(F.col(c)) for c in columns or CENTS if c in df.columns})


CENTS = ["importe_bruto", "comision_plataforma", "importe_neto", "costo_total", "margen_bruto"]


def sales(t: Tables, dish: bool = False, order: bool = False, customer: bool = False) -> DataFrame:
    """The sales view, joined only to the dimensions a query asks for."""
    rows = lines(t)
    if dish:
        rows = with_dish(rows, t)
    if order or customer:
        rows = joins.join_header(rows, heads(t))
    if customer:
        rows = rows.join(people(t), "id_cliente")
    return rows


def by_dish(t: Tables, *extra: str) -> DataFrame:
    """Lines summed per dish (and line attributes) before the dish join: a dish
    that sells a third of all lines is one row per map task."""
    sums = lines(t).groupBy("id_plato", *extra).agg(
        *[F.sum(c).alias(c) for c in ("cantidad", "importe_neto", "importe_bruto")])
    return in_units(with_dish(sums, t))


def by_order(t: Tables, *extra: str, dish: bool = False, orders: DataFrame | None = None) -> DataFrame:
    """Lines summed per order (and other attributes) before the order join.

    ``orders`` are the chosen headers; lines of others are left out before
    anything else, so only the chosen ones are shuffled on.
    """
    chosen = lines(t) if orders is None else lines(t).join(orders.select("id_pedido"), "id_pedido", "left_semi")
    rows = with_dish(chosen, t) if dish else chosen
    added = [c for c in [*CENTS, "cantidad"] if c in rows.columns]
    sums = rows.groupBy("id_pedido", *extra).agg(*[F.sum(c).alias(c) for c in added])
    return joins.join_header(in_units(sums), heads(t) if orders is None else orders)


def by_ref(t: Tables, *extra: str, dish: bool = False, order: bool = False, customer: bool = False) -> DataFrame:
    """One row per order reference for the KPI measures; headers and customers
    join these rows instead of the lines."""
    rows = with_dish(lines(t), t) if dish else lines(t)
    rows = measures.per_order(rows, "id_pedido", *extra, order="ref")
    if order or customer:
        rows = joins.join_header(rows, heads(t))
    if customer:
        rows = rows.join(people(t), "id_cliente").withColumnRenamed("es_cliente_identificado", "_ident")
    return rows


# Star built from the OLTP bindings, each table when it is first asked for ----------

class Star(Mapping):
    """The star's tables by name; a table is built when it is first read, with what it needs.

    Surrogate keys are staged by their operator; nothing is written a second time.
    The fact is handed out behind the gates only: a null or unmatched key stops the run.
    """

    def __init__(self, t: Tables):
        self._t, self._built, self._small = t, {}, warehouse.build_small_dims(t.spark)

    def __iter__(self):
        return iter(schemas.STAR)

    def __len__(self) -> int:
        return len(schemas.STAR)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            table = self._small[name] if name in self._small else getattr(self, f"_{name}")()
            if name == "fact_ventas":
                warehouse.check_star({name: table} | {dim: self[dim] for dim in self if dim != name})
            self._built[name] = table
        return self._built[name]

    def build(self) -> "Star":
        """All tables; the dimensions do not depend on each other, so their jobs are submitted together."""
        dims = [name for name in self if name.startswith("dim_")]
        with ThreadPoolExecutor(len(dims)) as pool:
            list(pool.map(self.__getitem__, dims))
        self["fact_ventas"]
        return self

    def _dim_fecha(self) -> DataFrame:
        return warehouse.build_dim_date(self._t.spark, *calendar_range(self._t), holidays(self._t))

    def _dim_cliente(self) -> DataFrame:
        return warehouse.build_dim_customer(clientes(self._t), AS_OF, SALT)

    def _dim_plato(self) -> DataFrame:
        return warehouse.build_dim_dish(platos(self._t))

    def _dim_empleado(self) -> DataFrame:
        return warehouse.build_dim_employee(empleados(self._t))

    def _fact_ventas(self) -> DataFrame:
        t = self._t
        internal = warehouse.build_fact_internal(detalle_cents(t), pedidos(t), self)
        external = warehouse.build_fact_external(warehouse.clean_feed(feed(t), platos(t), FIRST), self)
        return warehouse.build_fact(internal, external, t.lineitem.count())


class ChainedStar(Star):
    """The star of what the bulk loads accepted: rejected orders are absent, imputed dates present.

    An order of a customer that the client load refused is one of the walk-in customer.
    """

    def __init__(self, t: Tables):
        super().__init__(t)
        self._clients = stage(quality.load_clients(stg_cliente(t), FIRST), "clientes")
        loaded = quality.load_orders(stg_pedido(t), stg_detalle(t), FIRST, LOAD_DATE)
        known = self._clients.select("id_cliente").withColumn("_known", F.lit(1))
        self._orders = joins.attach(loaded["pedidos"], known, "id_cliente").withColumn(
            "id_cliente", F.when(F.col("_known").isNotNull(), F.col("id_cliente")).otherwise(F.lit(quality.WALK_IN))).drop("_known")
        self._lines = loaded["detalle"]

    def _dim_cliente(self) -> DataFrame:
        return warehouse.build_dim_customer(self._clients, AS_OF, SALT)

    def _fact_ventas(self) -> DataFrame:
        t = self._t
        internal = warehouse.build_fact_internal(self._lines, self._orders, self)
        clean = warehouse.clean_feed(feed(t), platos(t), FIRST)
        quality.require_zero(clean.agg(F.count_if(F.col("id_plato").isNull()).alias("n")), "n", "platos del feed sin correspondencia")
        return warehouse.build_fact(internal, warehouse.build_fact_external(clean, self), t.lineitem.count())


def chained_star(t: Tables) -> Star:
    """From the dirty inputs to the star, through every gate."""
    return once(t.spark, ("chained star", t.sf_dir), lambda: ChainedStar(t).build())


def build_star(t: Tables) -> Star:
    """The whole ETL: clean feed, seven dimensions, integrated fact, gates."""
    return Star(t).build()


def star(t: Tables) -> Star:
    """This session's star of a folder, until its staged tables are cleared."""
    return once(t.spark, ("star", t.sf_dir), lambda: Star(t))


# ---------------------------------------------------------------- SQL side

def _cols(cols: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in cols.items())


def _again(cols: dict[str, str], source: str, every: int, changed: str, value: str) -> str:
    repeat = {**cols, changed: value}
    return (f"SELECT {_cols(cols)}, 1 AS copia FROM {source} UNION ALL "
            f"SELECT * FROM (SELECT {_cols(repeat)}, 2 AS copia FROM {source}) WHERE fila % {every} = 0")


_FEED_FROM = ("(SELECT * FROM events WHERE event_type = 'purchase') e "
              f"JOIN platos p ON p.id_plato = {DISH_KEY.format(_DUCK('dishes'))}")

def half_even(n: str, d: str) -> str:
    """SQL for n / d rounded half to even, whole numbers, d > 0; the sign is taken out first."""
    q, r = f"(abs({n}) // ({d}))", f"(abs({n}) % ({d}))"
    return f"(sign({n})::BIGINT * ({q} + CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END))"


_NORM = "replace(lower(trim(strip_accents({0}), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')), 'cebiche', 'ceviche')"

_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "pedidos": ((), f"SELECT {_cols(pedidos_cols(_DUCK))} FROM orders"),
    "detalle": ((), f"SELECT {_cols(detalle_cols(_DUCK))} FROM lineitem"),
    "clientes": ((), f"SELECT {_cols(clientes_cols(_DUCK))} FROM customer"),
    "empleados": ((), f"SELECT {_cols(empleados_cols(_DUCK))} FROM supplier"),
    "platos": ((), f"SELECT {_cols(platos_cols(_DUCK))} FROM part"),
    "feed": (("platos",), _again(feed_cols(_DUCK), _FEED_FROM, 91, "precio_bruto", "CAST(NULL AS DECIMAL(12,2))")),
    "resenas": ((), f"SELECT {_cols(resenas_cols(_DUCK))} FROM events e JOIN part p ON p.p_partkey = {DISH_KEY.format(_DUCK('dishes'))}"),
    "stg_pedido": ((), _again(stg_pedido_cols(_DUCK), "orders", 97, "monto_total", "'1.00'")),
    "stg_detalle": ((), f"SELECT {_cols(stg_detalle_cols(_DUCK))} FROM lineitem"),
    "stg_cliente": ((), _again(stg_cliente_cols(_DUCK), "customer", 41, "email", "'otro@mail.example'")),
    "calendar_range": ((), f"""
        SELECT make_date(year(min(d)), 1, 1) AS primero, make_date(year(max(d)), 12, 31) AS ultimo FROM (
          SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(ts AS DATE) FROM events UNION ALL SELECT DATE '{LOAD_DATE}')"""),
    "holidays": (("calendar_range",),
                 "SELECT make_date(anio, h.m, h.d) AS fecha, h.n AS feriado FROM (SELECT unnest(range(year(primero), year(ultimo) + 1))::INT AS anio FROM calendar_range), "
                 "(VALUES " + ", ".join(f"({m}, {d}, '{n}')" for m, d, n in HOLIDAYS) + ") h(m, d, n) UNION ALL "
                 "SELECT CAST(" + EASTER.format("date_add").replace("CAST(((19", "to_days(CAST(((19", 1).replace(" AS INT))", " AS INT)))", 1)
                 + " - to_days(k) AS DATE), n FROM (SELECT unnest(range(year(primero), year(ultimo) + 1))::INT AS anio FROM calendar_range), "
                 "(VALUES " + ", ".join(f"({k}, '{n}')" for k, n in BEFORE_EASTER) + ") m(k, n)"),
    # sales view
    "lines": ((), """
        SELECT *, CAST(importe_bruto - comision_plataforma AS DECIMAL(12,2)) AS importe_neto FROM (
          SELECT l_orderkey AS id_pedido, l_partkey AS id_plato, l_suppkey AS id_empleado,
            CASE WHEN l_linestatus = 'O' THEN 'CSV externo' ELSE 'SQL Server' END AS origen,
            CASE WHEN l_linestatus = 'O' THEN 'APP-' ELSE 'SQL-' END || l_orderkey AS nro_pedido,
            CAST(l_quantity AS INT) AS cantidad, CAST(l_extendedprice AS DECIMAL(12,2)) AS importe_bruto,
            CAST(CASE WHEN l_linestatus = 'O' THEN round_even(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
              ELSE 0 END AS DECIMAL(12,2)) AS comision_plataforma,
            CASE WHEN l_linestatus = 'O' THEN l_linenumber END AS calificacion,
            CASE WHEN l_linestatus = 'O' THEN CAST(round(l_tax * 1000) AS INT) END AS tiempo_entrega_min,
            l_returnflag, l_linenumber
          FROM lineitem)"""),
    "dishes": ((), """
        SELECT p_partkey AS id_plato, p_brand AS nombre_plato, p_type AS categoria,
          CAST(p_retailprice AS DECIMAL(10,2)) AS precio_base,
          CAST(round_even(CAST(p_retailprice AS DECIMAL(10,2)) * 0.35, 2) AS DECIMAL(10,2)) AS costo_estimado FROM part"""),
    "sales": (("lines", "dishes"), """
        SELECT l.*, d.nombre_plato, d.categoria, d.precio_base, d.costo_estimado,
          l.cantidad * d.costo_estimado AS costo_total, l.importe_neto - l.cantidad * d.costo_estimado AS margen_bruto,
          o_custkey AS id_cliente, o_orderpriority AS canal, CAST(o_orderdate AS DATE) AS fecha,
          year(o_orderdate) AS anio, quarter(o_orderdate) AS trimestre, month(o_orderdate) AS mes_num,
          strftime(o_orderdate, '%Y-%m') AS anio_mes, n_name AS distrito, c_mktsegment AS tipo_cliente,
          c_mktsegment AS metodo_pago, CAST(c_acctbal > 0 AS INT) AS es_cliente_identificado
        FROM lines l JOIN dishes d USING (id_plato) JOIN orders ON o_orderkey = l.id_pedido
          JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"""),
    # star
    "dim_fecha": (("holidays", "calendar_range"), """
        SELECT CAST(strftime(f, '%Y%m%d') AS INT) AS sk_fecha, f AS fecha, year(f) AS anio, quarter(f) AS trimestre, month(f) AS mes_num,
          ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Setiembre','Octubre','Noviembre','Diciembre'][month(f)] AS mes_nombre,
          strftime(f, '%Y-%m') AS anio_mes, weekofyear(f) AS semana_iso, day(f) AS dia_mes, isodow(f) AS dia_semana_num,
          ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(f)] AS dia_semana,
          CAST(isodow(f) >= 6 AS INT) AS es_fin_semana, CAST(feriado IS NOT NULL AS INT) AS es_feriado, coalesce(feriado, '') AS nombre_feriado
        FROM (SELECT CAST(unnest(range(primero, ultimo + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS f FROM calendar_range)
          LEFT JOIN holidays ON fecha = f"""),
    "dim_cliente": (("clientes",), f"""
        SELECT 1 AS sk_cliente, 9999 AS id_cliente_nk, 'C-PASO' AS cliente_seudonimo, NULL::VARCHAR AS dni_hash, 'N/A' AS distrito,
          'Cliente de paso' AS tipo_cliente, DATE '2025-06-01' AS fecha_registro, 0 AS antiguedad_meses, 0 AS es_cliente_identificado
        UNION ALL SELECT 2, 9998, 'C-APP', NULL, 'N/A', 'Cliente App Delivery', DATE '2026-01-01', 0, 0
        UNION ALL SELECT 2 + row_number() OVER (ORDER BY id_cliente), id_cliente,
          'C-' || CASE WHEN length(id_cliente::VARCHAR) >= 5 THEN id_cliente::VARCHAR ELSE lpad(id_cliente::VARCHAR, 5, '0') END,
          upper(sha256('{SALT}' || dni)), distrito, tipo_cliente, fecha_registro,
          CAST(round_even((DATE '{AS_OF}' - fecha_registro) / 30.4::DOUBLE, 0) AS INT), 1
        FROM clientes WHERE id_cliente <> 9999"""),
    "dim_plato": (("platos",), f"""
        SELECT row_number() OVER (ORDER BY id_plato) AS sk_plato, id_plato AS id_plato_nk, nombre_plato, categoria, precio_base, costo_estimado,
          CAST(precio_base - costo_estimado AS DECIMAL(12,2)) AS margen_unitario,
          CAST({half_even('((precio_base - costo_estimado) * 100000)::BIGINT', '(precio_base * 100)::BIGINT')} * 0.1 AS DECIMAL(5,1)) AS margen_pct,
          CASE WHEN precio_base <= 0 OR precio_base > 1000 THEN NULL WHEN precio_base <= 15 THEN 'Económico (<=15)'
            WHEN precio_base <= 30 THEN 'Medio (16-30)' WHEN precio_base <= 40 THEN 'Alto (31-40)' ELSE 'Premium (>40)' END AS rango_precio
        FROM platos"""),
    "dim_empleado": (("empleados",), """
        SELECT 1 AS sk_empleado, 0 AS id_empleado_nk, 'Sin vendedor (plataforma externa)' AS nombre_completo, 'N/A' AS cargo
        UNION ALL SELECT 1 + row_number() OVER (ORDER BY id_empleado), id_empleado, nombre || ' ' || apellido, cargo FROM empleados"""),
    "dim_metodo_pago": ((), "SELECT * FROM (VALUES (1, 'Efectivo', 'Físico'), (2, 'Yape', 'Billetera digital'), (3, 'Plin', 'Billetera digital'), "
                            "(4, 'Tarjeta', 'Tarjeta'), (5, 'Pasarela de la plataforma', 'Plataforma')) x(sk_pago, metodo_pago, tipo_pago)"),
    "dim_canal": ((), "SELECT * FROM (VALUES (1, 'Salón', 'Presencial', 'SQL Server'), (2, 'Para llevar', 'Presencial', 'SQL Server'), "
                      "(3, 'Delivery propio', 'Delivery', 'SQL Server'), (4, 'PedidosYa', 'Delivery (app)', 'CSV externo'), "
                      "(5, 'Rappi', 'Delivery (app)', 'CSV externo')) x(sk_canal, canal, tipo_canal, origen_datos)"),
    "dim_turno": ((), "SELECT * FROM (VALUES (1, 'Almuerzo (11-15h)'), (2, 'Tarde (15-18h)'), (3, 'Noche (18-22h)'), (4, 'No registrado')) x(sk_turno, turno)"),
    "clean_feed": (("feed", "platos"), f"""
        SELECT f.* EXCLUDE (precio_bruto, copia, fila), p.id_plato, p.nombre_plato, CAST(fecha_iso AS DATE) AS fecha,
          CAST(precio_bruto IS NULL AS INT) AS precio_imputado,
          CAST(coalesce(precio_bruto, round_even(precio_base * cantidad * 1.10, 2)) AS DECIMAL(12,2)) AS precio_bruto
        FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_ref ORDER BY copia) AS rn FROM feed) WHERE rn = 1) f
          LEFT JOIN platos p ON {_NORM.format('p.nombre_plato')} = {_NORM.format('f.plato')}"""),
    "fact_internal": (("detalle", "pedidos", "dim_cliente", "dim_plato", "dim_empleado", "dim_metodo_pago", "dim_canal", "dim_turno"), """
        SELECT CAST(strftime(fecha_pedido, '%Y%m%d') AS INT) AS sk_fecha, sk_cliente, sk_plato, sk_empleado, sk_pago, sk_canal, sk_turno,
          'SQL-' || id_pedido AS nro_pedido, 'SQL Server' AS origen, cantidad, precio_unitario, subtotal AS importe_bruto,
          CAST(0 AS DECIMAL(12,2)) AS comision_plataforma, subtotal AS importe_neto,
          CAST(round_even(costo_estimado * cantidad, 2) AS DECIMAL(12,2)) AS costo_total,
          CAST(NULL AS INT) AS tiempo_entrega_min, CAST(NULL AS DECIMAL(2,1)) AS calificacion, id_pedido AS o1, id_detalle AS o2
        FROM detalle JOIN pedidos USING (id_pedido)
          LEFT JOIN dim_cliente c ON c.id_cliente_nk = id_cliente LEFT JOIN dim_plato p ON p.id_plato_nk = id_plato
          LEFT JOIN dim_empleado e ON e.id_empleado_nk = id_empleado LEFT JOIN dim_metodo_pago m USING (metodo_pago)
          LEFT JOIN dim_canal k ON k.canal = canal_interno
          LEFT JOIN dim_turno u ON u.turno = CASE WHEN CAST(left(hora_pedido, 2) AS INT) < 15 THEN 'Almuerzo (11-15h)'
            WHEN CAST(left(hora_pedido, 2) AS INT) < 18 THEN 'Tarde (15-18h)' ELSE 'Noche (18-22h)' END"""),
    "fact_external": (("clean_feed", "dim_plato", "dim_canal"), f"""
        SELECT CAST(strftime(fecha, '%Y%m%d') AS INT) AS sk_fecha, 2 AS sk_cliente, sk_plato, 1 AS sk_empleado, 5 AS sk_pago, sk_canal, 4 AS sk_turno,
          order_ref AS nro_pedido, 'CSV externo' AS origen, cantidad,
          CAST({half_even('(precio_bruto * 100)::BIGINT', 'cantidad')} * 0.01 AS DECIMAL(12,2)) AS precio_unitario,
          precio_bruto AS importe_bruto, CAST(round_even(precio_bruto * comision_pct * 0.01, 2) AS DECIMAL(12,2)) AS comision_plataforma,
          CAST(precio_bruto - round_even(precio_bruto * comision_pct * 0.01, 2) AS DECIMAL(12,2)) AS importe_neto,
          CAST(round_even(costo_estimado * cantidad, 2) AS DECIMAL(12,2)) AS costo_total,
          tiempo_entrega_min, calificacion, CAST(NULL AS BIGINT) AS o1, CAST(NULL AS BIGINT) AS o2
        FROM clean_feed LEFT JOIN dim_plato ON id_plato_nk = id_plato LEFT JOIN dim_canal k ON k.canal = plataforma"""),
    "fact_ventas": (("fact_internal", "fact_external"), """
        SELECT row_number() OVER (ORDER BY rama, o1, o2, nro_pedido, sk_plato, sk_empleado, cantidad, importe_bruto, precio_unitario) AS sk_venta,
          * EXCLUDE (rama, o1, o2), CAST(importe_neto - costo_total AS DECIMAL(12,2)) AS margen_bruto
        FROM (SELECT 1 AS rama, * FROM fact_internal UNION ALL SELECT 2, * FROM fact_external)"""),
    "star_view": (("fact_ventas", "dim_fecha", "dim_cliente", "dim_plato", "dim_empleado", "dim_metodo_pago", "dim_canal", "dim_turno"), """
        SELECT * FROM fact_ventas JOIN dim_fecha USING (sk_fecha) JOIN dim_plato USING (sk_plato) JOIN dim_canal USING (sk_canal)
          JOIN dim_turno USING (sk_turno) JOIN dim_metodo_pago USING (sk_pago) JOIN dim_empleado USING (sk_empleado)
          JOIN (SELECT sk_cliente, id_cliente_nk, distrito, tipo_cliente, es_cliente_identificado FROM dim_cliente) USING (sk_cliente)"""),
}


def sql(needs: str, body: str) -> str:
    """``body`` after a WITH clause holding the named bindings and what they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for dep in _CTES[name][0]:
            add(dep)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    if not order:
        return body
    ctes = ",\n".join(f"{name} AS ({_CTES[name][1]})" for name in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
