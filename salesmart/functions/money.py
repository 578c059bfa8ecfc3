"""Amount expressions.

Amounts are DECIMAL while computing and DOUBLE when published.  Rows that come
in large numbers may carry whole cents as BIGINT instead: they add up exactly,
cost a fraction of a decimal sum, and turn into DECIMAL after the first
aggregate, so no long-running total can overflow.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(12,2)"

# Price bands (upper bound, label) and sale-size labels.
PRICE_BANDS = [(15, "Económico (<=15)"), (30, "Medio (16-30)"), (40, "Alto (31-40)"), (1000, "Premium (>40)")]
NO_AMOUNT, BIG_SALE, SMALL_SALE = "Sin monto", "Venta Grande", "Venta Pequeña"


def amount(c: Column) -> Column:
    return c.cast(MONEY)


def money(c: Column, digits: int = 2) -> Column:
    """Half-even rounding."""
    return F.bround(c, digits)


def publish(c: Column) -> Column:
    return c.cast("double")


def cents(c: Column) -> Column:
    """Whole cents of a two-digit amount; exact below 9e13."""
    return F.rint(c * 100).cast("bigint")


def units(c: Column) -> Column:
    """Amount of a number of cents."""
    return (c.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("decimal(21,2)")


def half_even_div(n: Column, d: Column | int) -> Column:
    """n / d in whole numbers, rounded half to even, for d > 0; a negative n rounds like its amount."""
    d = F.lit(d) if isinstance(d, int) else d
    amount = F.abs(n)
    q, twice = F.call_function("div", amount, d), (amount % d) * 2
    rounded = q + F.when((twice > d) | ((twice == d) & (q % 2 == 1)), 1).otherwise(0)
    return F.when(n < 0, -rounded).otherwise(rounded)


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; NULL when b is zero or NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def price_band(c: Column) -> Column:
    """Right-closed bands over (0, 1000]; NULL outside."""
    band = F.when(c <= 0, F.lit(None))
    for upper, label in PRICE_BANDS:
        band = band.when(c <= upper, label)
    return band


def sale_size(c: Column) -> Column:
    return F.when(c.isNull(), NO_AMOUNT).when(c > 150, BIG_SALE).otherwise(SMALL_SALE)


def differs(a: Column, b: Column, tol: float = 0.01) -> Column:
    """|a - b| > tol; a NULL on either side passes."""
    return F.coalesce(F.abs(a - b) > F.lit(tol).cast("decimal(10,4)"), F.lit(False))


def commission(gross: Column, pct: Column) -> Column:
    """gross * pct / 100, rounded half to even."""
    return F.bround(gross * pct / 100, 2).cast(MONEY)


def sale_amounts(gross: Column, pct: Column, qty: Column, unit_cost: Column) -> dict[str, Column]:
    """Commission, net, unit price, cost and margin of one delivery sale."""
    fee = commission(gross, pct)
    net = gross - fee
    cost = F.bround(unit_cost * qty, 2)
    return {
        "precio_unitario": F.bround(gross / qty, 2).cast(MONEY),
        "importe_bruto": gross.cast(MONEY),
        "comision_plataforma": fee,
        "importe_neto": net.cast(MONEY),
        "costo_total": cost.cast(MONEY),
        "margen_bruto": F.bround(net - cost, 2).cast(MONEY),
    }
