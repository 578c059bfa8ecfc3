"""Pinned schemas as DDL text: nothing is inferred at read time."""

from __future__ import annotations

import re


def all_strings(*columns: str) -> str:
    return ", ".join(f"{c} string" for c in columns)


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat schema."""
    return [tuple(part.split(" ", 1)) for part in ddl.split(", ")]


# Raw feeds, as typed after the cast.
FEEDS = {
    "clientes": (
        "id_cliente int, dni string, nombre string, apellido string, distrito string, "
        "tipo_cliente string, fecha_registro string, email string, telefono string"),
    "personal": (
        "id_empleado int, dni_empleado string, nombre string, apellido string, cargo string, "
        "salario_mensual decimal(10,2)"),
    "platos": (
        "id_plato int, nombre_plato string, categoria string, precio_base decimal(10,2), "
        "costo_estimado decimal(10,2)"),
    "pedidos": (
        "id_pedido int, fecha_pedido string, hora_pedido string, id_cliente int, id_empleado int, "
        "canal_interno string, metodo_pago string, monto_total decimal(10,2)"),
    "detalle_pedido": (
        "id_detalle int, id_pedido int, id_plato int, cantidad int, precio_unitario decimal(10,2), "
        "subtotal decimal(10,2)"),
    "asistencia": (
        "id_asistencia int, id_empleado int, fecha date, hora_ingreso string, "
        "horas_trabajadas decimal(5,2), tardanza_min int"),
    "delivery": (
        "order_ref string, fecha_iso date, plataforma string, plato string, cantidad int, "
        "precio_bruto decimal(10,2), comision_pct int, distrito_entrega string, "
        "tiempo_entrega_min int, calificacion decimal(2,1)"),
    "resenas": (
        "_id bigint, plato string, puntuacion int, comentario string, fuente string, fecha string, "
        "id_cliente bigint, etiquetas array<string>, respuesta_local string, util_votos int, "
        "visita struct<acompanantes:int, ocasion:string>"),
    "feriados": "fecha date, feriado string",
    "menu": (
        "plato_principal string, precio_base decimal(10,2), ingredientes_extra array<string>, "
        "alergenos array<string>, "
        "resenas_clientes array<struct<usuario:string, puntuacion:int, comentario:string>>, "
        "temporada string, vegetariano boolean"),
}

# All-string staging tables of the bulk load.
STAGING = {
    "stg_pedido": all_strings(
        "id_pedido", "fecha_pedido", "hora_pedido", "id_cliente", "id_empleado", "canal_interno",
        "metodo_pago", "monto_total"),
    "stg_detalle": all_strings(
        "id_detalle", "id_pedido", "id_plato", "cantidad", "precio_unitario", "subtotal"),
    "stg_cliente": all_strings(
        "id_cliente", "dni", "nombre", "apellido", "distrito", "tipo_cliente", "fecha_registro",
        "email", "telefono"),
}

# Star schema.  Keys of tables that grow are bigint; amounts are decimals.
STAR = {
    "dim_fecha": (
        "sk_fecha int, fecha date, anio int, trimestre int, mes_num int, mes_nombre string, "
        "anio_mes string, semana_iso int, dia_mes int, dia_semana_num int, dia_semana string, "
        "es_fin_semana int, es_feriado int, nombre_feriado string"),
    "dim_cliente": (
        "sk_cliente bigint, id_cliente_nk bigint, cliente_seudonimo string, dni_hash string, "
        "distrito string, tipo_cliente string, fecha_registro date, antiguedad_meses int, "
        "es_cliente_identificado int"),
    "dim_plato": (
        "sk_plato bigint, id_plato_nk bigint, nombre_plato string, categoria string, "
        "precio_base decimal(12,2), costo_estimado decimal(12,2), margen_unitario decimal(12,2), "
        "margen_pct decimal(5,1), rango_precio string"),
    "dim_empleado": (
        "sk_empleado bigint, id_empleado_nk bigint, nombre_completo string, cargo string"),
    "dim_metodo_pago": "sk_pago int, metodo_pago string, tipo_pago string",
    "dim_canal": "sk_canal int, canal string, tipo_canal string, origen_datos string",
    "dim_turno": "sk_turno int, turno string",
    "fact_ventas": (
        "sk_venta bigint, sk_fecha int, sk_cliente bigint, sk_plato bigint, sk_empleado bigint, "
        "sk_pago int, sk_canal int, sk_turno int, nro_pedido string, origen string, cantidad int, "
        "precio_unitario decimal(12,2), importe_bruto decimal(12,2), "
        "comision_plataforma decimal(12,2), importe_neto decimal(12,2), costo_total decimal(12,2), "
        "tiempo_entrega_min int, calificacion decimal(2,1), margen_bruto decimal(12,2)"),
}

# The fact as the CSV exchange form is read: same 19 columns, amounts as double.
FACT_CSV = re.sub(r"decimal\(\d+,\d+\)", "double", STAR["fact_ventas"])

# Column order of the fact table.
FACT_COLUMNS = [name for name, _ in fields(STAR["fact_ventas"])]

AUDIT_COLUMNS = ["accion", "tabla_afectada", "valor_anterior", "valor_nuevo"]

# Shared test tables.
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
