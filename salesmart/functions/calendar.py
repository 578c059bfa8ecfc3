"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spanish calendar names and shift labels.
MONTHS = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
          "Setiembre", "Octubre", "Noviembre", "Diciembre"]
WEEKDAYS = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
LUNCH, AFTERNOON, NIGHT = "Almuerzo (11-15h)", "Tarde (15-18h)", "Noche (18-22h)"
SHIFTS = [LUNCH, AFTERNOON, NIGHT]
NO_SHIFT = "No registrado"


def _pick(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def month_name(month: Column) -> Column:
    return _pick(MONTHS, month)


def weekday_number(d: Column) -> Column:
    """Monday is 1."""
    return F.weekday(d) + 1


def weekday_name(number: Column) -> Column:
    return _pick(WEEKDAYS, number)


def date_key(d: Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def shift_of_hour(hour: Column) -> Column:
    return F.when(hour < 15, LUNCH).when(hour < 18, AFTERNOON).when(hour.isNotNull(), NIGHT)


def shift_of(hhmm: Column) -> Column:
    """Shift of an ``HH:mm`` text."""
    return shift_of_hour(F.substring(hhmm, 1, 2).try_cast("int"))


def calendar_parts(d: Column) -> dict[str, Column]:
    """The calendar columns of the date dimension, in order."""
    number = weekday_number(d)
    return {
        "sk_fecha": date_key(d),
        "fecha": d,
        "anio": F.year(d),
        "trimestre": F.quarter(d),
        "mes_num": F.month(d),
        "mes_nombre": month_name(F.month(d)),
        "anio_mes": year_month(d),
        "semana_iso": F.weekofyear(d),
        "dia_mes": F.dayofmonth(d),
        "dia_semana_num": number,
        "dia_semana": weekday_name(number),
        "es_fin_semana": (number >= 6).cast("int"),
    }



def safe_date(c: Column) -> Column:
    """Day/month/year text to a date; anything else gives NULL."""
    return F.try_to_date(c, "d/M/yyyy")


def tenure_months(registered: Column, as_of: dt.date) -> Column:
    """Days since registration / 30.4, rounded half to even."""
    return F.bround(F.date_diff(F.lit(as_of), registered) / F.lit(30.4), 0).cast("int")


def date_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("fecha"))
