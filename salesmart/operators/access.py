"""Who sees what: pseudonyms, masks, row filters, column lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import masks


# Roles.
ADMIN, ANALYST, AUDITOR = "Rol_Administrador", "Rol_AnalistaDatos", "Rol_Auditor"
SELLER, CUSTOMER, KITCHEN, OWNER = "Rol_Vendedor", "Rol_Cliente", "Rol_Cocina", "db_owner"
UNMASK = {ADMIN, OWNER}


def pseudonymise(customers: DataFrame, salt: str) -> DataFrame:
    """Hashed id document and the non-identifying columns only; NULL ids stay NULL."""
    return customers.select(
        "id_cliente", masks.hash_id(F.col("dni"), salt).alias("dni_hash"), "distrito", "tipo_cliente", "fecha_registro")


Policy = Mapping[str, Callable[[Column], Column]]

# Masked columns.
CUSTOMER_POLICY: Policy = {
    "email": masks.mask_email,
    "telefono": lambda c: masks.mask_partial(c, 0, "XXXXX", 4),
}


def employee_policy(df: DataFrame) -> Policy:
    salary = df.schema["salario_mensual"].dataType
    return {
        "dni_empleado": lambda c: masks.mask_partial(c, 0, "XXXX", 4),
        "salario_mensual": lambda c: masks.mask_default(c, salary),
    }


def masked_view(df: DataFrame, policy: Policy, role: str) -> DataFrame:
    if role in UNMASK:
        return df
    return df.withColumns({name: mask(F.col(name)) for name, mask in policy.items()})


def row_filter(df: DataFrame, mapping: DataFrame, user: str, roles: Collection[str], key: str = "id_cliente") -> DataFrame:
    """Customers see rows of the customer mapped to their user; other roles see all.

    ``mapping`` has (key, usuario_bd); a user without a mapping sees nothing.
    """
    if CUSTOMER not in roles or OWNER in roles:
        return df
    own = mapping.filter(F.col("usuario_bd") == user).select(key)
    return df.join(own, key, "left_semi")


def allowed_columns(df: DataFrame, allowed: Collection[str]) -> DataFrame:
    """Only the columns on the list, in the table's order."""
    return df.select(*[c for c in df.columns if c in allowed])


def my_orders(orders: DataFrame, mapping: DataFrame, user: str, roles: Collection[str]) -> DataFrame:
    return row_filter(orders, mapping, user, roles).select(
        "id_pedido", "fecha_pedido", "canal_interno", "metodo_pago", "monto_total")


def today_orders(orders: DataFrame, as_of: dt.date) -> DataFrame:
    return orders.filter(F.col("fecha_pedido") == F.lit(as_of))


def kitchen_view(orders: DataFrame, lines: DataFrame, dishes: DataFrame, as_of: dt.date) -> DataFrame:
    """What to prepare on a day: no amounts, no customers."""
    return (
        today_orders(orders, as_of)
        .join(lines, "id_pedido").join(dishes, "id_plato")
        .select("id_pedido", "hora_pedido", "canal_interno", "nombre_plato", "cantidad"))
