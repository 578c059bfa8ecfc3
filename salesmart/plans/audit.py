"""Audit of changes: AU1-AU8.  The later snapshot is derived from the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, quality
from ..session import staging_dir
from ..sources import writers
from ..sources.tables import Tables
from . import bindings as b
from .quality import ACCEPTED, LINES
from .registry import query

NEW_SALARY = ("CASE WHEN id_empleado % 4 = 0 THEN CAST(coalesce(salario_mensual, 1000.00) + 100 AS DECIMAL(10,2)) "
              "WHEN id_empleado % 6 = 1 THEN NULL ELSE salario_mensual END")
NEW_ROLE = "CASE WHEN id_empleado % 3 = 0 THEN 'Cajero' ELSE cargo END"
NEW_TOTAL = "CASE WHEN id_pedido % 8 = 0 THEN CAST(monto_total * 2 AS DECIMAL(12,2)) ELSE monto_total END"
OLD_TOTAL = "CASE WHEN id_pedido % 24 = 0 THEN CAST(0.01 AS DECIMAL(12,2)) ELSE monto_total END"


@query("au1_audit_salary", b.sql("empleados", f"""
    SELECT 'Cambio de salario del empleado ID ' || id_empleado AS accion, 'Empleado' AS tabla_afectada, salario_mensual::VARCHAR AS valor_anterior, n::VARCHAR AS valor_nuevo
    FROM (SELECT *, {NEW_SALARY} AS n FROM empleados) WHERE coalesce(n, -1) <> coalesce(salario_mensual, -1)"""))
def _(t: Tables):
    before = b.empleados(t)
    return audit.audit_salary(before, before.withColumn("salario_mensual", F.expr(NEW_SALARY)))


@query("au2_audit_role", b.sql("empleados", f"""
    SELECT 'Cambio de cargo del empleado ID ' || id_empleado AS accion, 'Empleado' AS tabla_afectada, cargo AS valor_anterior, n AS valor_nuevo
    FROM (SELECT *, {NEW_ROLE} AS n FROM empleados) WHERE n <> cargo"""))
def _(t: Tables):
    before = b.empleados(t)
    return audit.audit_role(before, before.withColumn("cargo", F.expr(NEW_ROLE)))


@query("au3_audit_removed", b.sql("empleados", """
    SELECT 'Baja de empleado ID ' || id_empleado AS accion, 'Empleado' AS tabla_afectada, cargo AS valor_anterior, NULL::VARCHAR AS valor_nuevo
    FROM empleados WHERE cargo = 'Ayudante'"""))
def _(t: Tables):
    before = b.empleados(t)
    return audit.audit_removed(before, before.filter("cargo <> 'Ayudante'"))


def _images(t: Tables):
    before = b.pedidos(t).withColumn("monto_total", F.expr(OLD_TOTAL))
    return before, b.pedidos(t).withColumn("monto_total", F.expr(NEW_TOTAL))


@query("au4_audit_amount", b.sql("pedidos", f"""
    SELECT 'Modificación de monto del pedido ' || id_pedido AS accion, 'Pedido' AS tabla_afectada, o::VARCHAR AS valor_anterior, n::VARCHAR AS valor_nuevo
    FROM (SELECT *, {OLD_TOTAL} AS o, {NEW_TOTAL} AS n FROM pedidos) WHERE n <> o AND o > 0.01"""))
def _(t: Tables):
    return audit.audit_amount(*_images(t))


@query("au5_audit_cancelled", b.sql("pedidos", """
    SELECT 'Anulación (DELETE) del pedido ' || id_pedido AS accion, 'Pedido' AS tabla_afectada, monto_total::VARCHAR AS valor_anterior, NULL::VARCHAR AS valor_nuevo
    FROM pedidos WHERE metodo_pago = 'Plin'"""))
def _(t: Tables):
    before = b.pedidos(t)
    return audit.audit_cancelled(before, before.filter("metodo_pago <> 'Plin'"))


UPDATE_COLUMNS = [
    "CASE WHEN s_suppkey % 10 = 3 THEN -(s_suppkey + 1) ELSE s_suppkey + 1 END AS id_empleado",
    "CASE WHEN s_suppkey % 10 = 5 THEN NULL ELSE CAST(s_suppkey * 37 % 3000 AS DECIMAL(10,2)) END AS nuevo_salario"]
UPDATES = ", ".join(UPDATE_COLUMNS)


def _update(t: Tables):
    updates = t.supplier.filter("s_acctbal < 5000").selectExpr(*UPDATE_COLUMNS)
    return audit.update_salary(b.empleados(t), updates)


@query("au6_update_salary", b.sql("empleados", f"""
    WITH u AS (SELECT {UPDATES} FROM supplier WHERE s_acctbal < 5000)
    SELECT id_empleado, coalesce(CASE WHEN nuevo_salario >= 1130 THEN nuevo_salario END, salario_mensual)::DOUBLE AS salario_mensual FROM empleados LEFT JOIN u USING (id_empleado)"""))
def _(t: Tables):
    return _update(t)[0].select("id_empleado", "salario_mensual")


@query("au6_update_errors", b.sql("empleados", f"""
    WITH u AS (SELECT {UPDATES} FROM supplier WHERE s_acctbal < 5000)
    SELECT 'Empleado' AS tabla, id_empleado AS id_registro, CASE WHEN id_empleado < 0 THEN 51010 ELSE 51011 END AS numero_error,
      CASE WHEN id_empleado < 0 THEN 'Empleado inexistente' ELSE 'Salario menor a la RMV vigente (S/ 1 130) o nulo' END AS mensaje
    FROM u WHERE id_empleado < 0 OR nuevo_salario IS NULL OR nuevo_salario < 1130"""))
def _(t: Tables):
    return _update(t)[1]


@query("au7_append_audit", b.sql("empleados pedidos", """
    SELECT 'Baja de empleado ID ' || id_empleado AS accion, 'Empleado' AS tabla_afectada, cargo AS valor_anterior, NULL::VARCHAR AS valor_nuevo
    FROM empleados WHERE cargo = 'Ayudante'
    UNION ALL SELECT 'Anulación (DELETE) del pedido ' || id_pedido, 'Pedido', monto_total::VARCHAR, NULL FROM pedidos WHERE metodo_pago = 'Plin'"""))
def _(t: Tables):
    path = staging_dir(t.spark, "log_auditoria")
    people, orders = b.empleados(t), b.pedidos(t)
    writers.append_audit(audit.audit_removed(people, people.filter("cargo <> 'Ayudante'")), path)
    writers.append_audit(audit.audit_cancelled(orders, orders.filter("metodo_pago <> 'Plin'")), path)
    return t.spark.read.parquet(path)


@query("au8_load_message", b.sql("stg_pedido stg_detalle", f"""
    WITH {ACCEPTED}, {LINES}
    SELECT 'Carga masiva pedidos' AS accion, 'Pedido' AS tabla_afectada, NULL::VARCHAR AS valor_anterior,
      'ins_pedidos=' || (SELECT count(*) FROM ok) || '; ins_detalle=' || (SELECT count(*) FROM lin WHERE id_pedido IN (SELECT id_pedido FROM ok))
      || '; dup=' || (count(*) - count(DISTINCT id_pedido)) || '; cliente_paso=' || count(*) FILTER (WHERE copia = 1 AND id_cliente = '')
      || '; fecha_imputada=' || count(*) FILTER (WHERE copia = 1 AND try_strptime(fecha_pedido, '%d/%m/%Y') IS NULL)
      || '; monto_rechazado=' || (SELECT count(*) FROM ped WHERE monto_total IS NULL OR monto_total <= 0)
      || '; huerfanos=' || (SELECT count(*) FROM lin WHERE id_pedido NOT IN (SELECT id_pedido FROM ok)) AS valor_nuevo FROM stg_pedido"""))
def _(t: Tables):
    counters = quality.load_counters(b.stg_pedido(t), b.stg_detalle(t), b.FIRST, b.LOAD_DATE)
    return audit.load_message(counters, "Carga masiva pedidos", "Pedido")


@query("au8_client_message", b.sql("stg_cliente", """
    SELECT 'Carga masiva clientes: insertados=' || count(*) FILTER (WHERE rn = 1 AND TRY_CAST(id_cliente AS BIGINT) IS NOT NULL)
      || ', duplicados=' || count(*) FILTER (WHERE rn > 1)
      || ', DNI inválidos=' || count(*) FILTER (WHERE rn = 1 AND NOT coalesce(regexp_full_match(dni, '[0-9]{8}'), false)) AS accion,
      'Cliente' AS tabla_afectada, NULL::VARCHAR AS valor_anterior, 'customer' AS valor_nuevo
    FROM (SELECT *, row_number() OVER (PARTITION BY id_cliente ORDER BY copia) AS rn FROM stg_cliente)"""))
def _(t: Tables):
    return audit.client_message(quality.client_counters(b.stg_cliente(t), b.FIRST), "customer")
