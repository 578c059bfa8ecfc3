"""Unions: U1-U4."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import documents, stats, warehouse
from ..operators.measures import EXTERNAL, INTERNAL
from ..sources.tables import Tables
from . import bindings as b
from .registry import query

FINAL = {"Cliente": "customer", "Pedido": "orders", "Detalle_Pedido": "lineitem"}


@query("u01_labelled_counts", " UNION ALL ".join(f"SELECT '{label}' AS tabla, count(*) AS filas FROM {name}" for label, name in FINAL.items()))
def _(t: Tables):
    return stats.table_counts({label: getattr(t, name) for label, name in FINAL.items()})


@query("u02_union_facts", b.sql("lines", """
    SELECT nro_pedido, origen, importe_neto::DOUBLE AS importe_neto, calificacion, tiempo_entrega_min FROM lines"""))
def _(t: Tables):
    rows = b.in_units(b.lines(t))
    own = rows.filter(F.col("origen") == INTERNAL).select("nro_pedido", "origen", "importe_neto")
    apps = rows.filter(F.col("origen") == EXTERNAL).select("nro_pedido", "origen", "importe_neto", "calificacion", "tiempo_entrega_min")
    return warehouse.union_facts(own, apps)


@query("u03_special_members", b.sql("clientes", """
    SELECT id_cliente, nombre, apellido, distrito, fecha_registro FROM clientes
    UNION ALL SELECT 9999, 'CLIENTE', 'DE PASO', 'N/A', DATE '2025-06-01'"""))
def _(t: Tables):
    people = b.clientes(t).select("id_cliente", "nombre", "apellido", "distrito", "fecha_registro")
    return warehouse.with_special_members(people, [(9999, "CLIENTE", "DE PASO", "N/A", dt.date(2025, 6, 1))])


@query("u04_insert_docs", """
    SELECT p_name AS plato_principal, p_retailprice AS precio_base, p_brand AS temporada, NULL::INT AS vegetariano FROM part WHERE p_size <= 25
    UNION ALL SELECT p_name, p_retailprice, NULL, 1 FROM part WHERE p_size > 25""")
def _(t: Tables):
    base = t.part.withColumnsRenamed({"p_name": "plato_principal", "p_retailprice": "precio_base"})
    seasonal = base.filter("p_size <= 25").select("plato_principal", "precio_base", F.col("p_brand").alias("temporada"))
    green = base.filter("p_size > 25").select("plato_principal", "precio_base", F.lit(1).alias("vegetariano"))
    return documents.insert_docs(seasonal, green)
