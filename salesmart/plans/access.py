"""Privacy and access: G1-G9."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import masks
from ..operators import access, warehouse
from ..sources.tables import Tables
from . import bindings as b
from .registry import query


@query("g01_pseudonymise", b.sql("clientes", f"""
    SELECT id_cliente, upper(sha256('{b.SALT}' || dni)) AS dni_hash, distrito, tipo_cliente, fecha_registro FROM clientes"""))
def _(t: Tables):
    return access.pseudonymise(b.clientes(t), b.SALT)


@query("g02_employee_view", b.sql("empleados", "SELECT id_empleado AS id_empleado_nk, nombre || ' ' || apellido AS nombre_completo, cargo FROM empleados"))
def _(t: Tables):
    return warehouse.employee_view(b.empleados(t))


@query("g03_mask_email", b.sql("clientes", "SELECT id_cliente, left(email, 1) || 'XXX@XXXX.com' AS email FROM clientes"))
def _(t: Tables):
    return b.clientes(t).select("id_cliente", masks.mask_email(F.col("email")).alias("email"))


@query("g04_mask_partial", b.sql("clientes", "SELECT id_cliente, 'XXXXX' || right(telefono, 4) AS telefono, left(dni, 2) || '**' || right(dni, 1) AS dni FROM clientes"))
def _(t: Tables):
    return b.clientes(t).select(
        "id_cliente", masks.mask_partial(F.col("telefono"), 0, "XXXXX", 4).alias("telefono"),
        masks.mask_partial(F.col("dni"), 2, "**", 1).alias("dni"))


@query("g05_mask_default", b.sql("empleados", """
    SELECT id_empleado, CASE WHEN salario_mensual IS NOT NULL THEN 0.0::DOUBLE END AS salario_mensual, 'xxxx' AS cargo FROM empleados"""))
def _(t: Tables):
    people = b.empleados(t)
    kinds = {f.name: f.dataType for f in people.schema.fields}
    return people.select("id_empleado", *[masks.mask_default(F.col(c), kinds[c]).alias(c) for c in ("salario_mensual", "cargo")])


@query("g06_masked_view_seller", b.sql("clientes", """
    SELECT id_cliente, left(email, 1) || 'XXX@XXXX.com' AS email, 'XXXXX' || right(telefono, 4) AS telefono FROM clientes"""))
def _(t: Tables):
    people = b.clientes(t).select("id_cliente", "email", "telefono")
    return access.masked_view(people, access.CUSTOMER_POLICY, access.SELLER)


@query("g06_masked_view_admin", b.sql("clientes", "SELECT id_cliente, email, telefono FROM clientes"))
def _(t: Tables):
    people = b.clientes(t).select("id_cliente", "email", "telefono")
    return access.masked_view(people, access.CUSTOMER_POLICY, access.ADMIN)


@query("g06_masked_employees", b.sql("empleados", """
    SELECT id_empleado, 'XXXX' || right(dni_empleado, 4) AS dni_empleado, CASE WHEN salario_mensual IS NOT NULL THEN 0.0::DOUBLE END AS salario_mensual FROM empleados"""))
def _(t: Tables):
    people = b.empleados(t).select("id_empleado", "dni_empleado", "salario_mensual")
    return access.masked_view(people, access.employee_policy(people), access.ANALYST)


def _users(t: Tables):
    """Every customer with a database user of their own."""
    return b.clientes(t).select("id_cliente", F.concat(F.lit("u_cliente"), F.col("id_cliente").cast("string")).alias("usuario_bd"))


@query("g07_row_filter_customer", b.sql("pedidos", "SELECT id_pedido, id_cliente FROM pedidos WHERE id_cliente = 10007"))
def _(t: Tables):
    return access.row_filter(b.pedidos(t), _users(t), "u_cliente10007", {access.CUSTOMER}).select("id_pedido", "id_cliente")


@query("g07_row_filter_seller", b.sql("pedidos", "SELECT id_pedido, id_cliente FROM pedidos"))
def _(t: Tables):
    return access.row_filter(b.pedidos(t), _users(t), "u_vendedor", {access.SELLER}).select("id_pedido", "id_cliente")


@query("g08_role_view", b.sql("clientes", "SELECT id_cliente, nombre, apellido, tipo_cliente FROM clientes"))
def _(t: Tables):
    return access.allowed_columns(b.clientes(t), {"id_cliente", "nombre", "apellido", "tipo_cliente"})


@query("g09_my_orders", b.sql("pedidos", """
    SELECT id_pedido, fecha_pedido, canal_interno, metodo_pago, monto_total::DOUBLE AS monto_total FROM pedidos WHERE id_cliente = 10007"""))
def _(t: Tables):
    return access.my_orders(b.pedidos(t), _users(t), "u_cliente10007", {access.CUSTOMER})
