"""Load rules and checks.

Order of the order load: R1 repeats -> R2 missing customer and R3 bad date
counted on what R1 keeps -> R4 amount -> R6 lines of orders that were not kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import calendar, money, text
from ..session import stage
from ..sources.feeds import literal_rows
from . import joins, stats, windows

WALK_IN = 9999

# Messages of the load rules and checks.
BAD_AMOUNT = "monto_total <= 0 o no numérico: pedido rechazado"
ORPHAN_LINE = "detalle huérfano: pedido padre rechazado"
BROKEN_LINE = "línea con campos de menos o de más: no se carga"
BLOCKED_LINES = "Intento bloqueado: subtotal no coincide con cantidad x precio"


class ValidationError(Exception):
    """A whole batch was refused."""


def impute_customer(df: DataFrame, default: int = WALK_IN) -> DataFrame:
    """R2: blank or non-numeric customer -> default; ``es_paso`` flags blanks only."""
    blank = text.blank_to_null(F.col("id_cliente")).isNull()
    return df.withColumns({
        "es_paso": blank.cast("int"),
        "id_cliente": text.or_default(text.safe_cast(F.col("id_cliente"), "bigint"), default),
    })


def impute_date(df: DataFrame, load_date: dt.date) -> DataFrame:
    """R3: unreadable date -> load date with ``fecha_imputada`` = 1."""
    parsed = calendar.safe_date(F.col("fecha_pedido"))
    return df.withColumns({
        "fecha_imputada": parsed.isNull().cast("int"),
        "fecha_pedido": F.coalesce(parsed, F.lit(load_date)),
    })


def bad_amount(c: Column) -> Column:
    return c.isNull() | (c <= 0)


def reject_amount(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """R4: (accepted, rejected); NULL or non-numeric amounts are rejected too."""
    typed = df.withColumn("monto_total", text.safe_cast(F.col("monto_total").cast("string"), "decimal(12,2)"))
    bad = bad_amount(F.col("monto_total"))
    return typed.filter(~bad), typed.filter(bad)


def null_invalid_id(df: DataFrame, column: str) -> DataFrame:
    """R5: keep the row, blank the id when it is not eight digits."""
    return df.withColumn(column, F.when(text.is_valid_id(F.col(column)), F.col(column)))


def reject_orphans(lines: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """R6: (lines of accepted orders, the other lines)."""
    return joins.keep_accepted(lines, orders), joins.find_orphans(lines, orders)


def error_rows(df: DataFrame, table: str, key: str, reason: str, value: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("tabla"), F.col(key).cast("bigint").alias("id_registro"),
        F.lit(reason).alias("motivo"), F.col(value).cast("double").alias("valor"))


def error_log(*rejects: DataFrame) -> DataFrame:
    """(tabla, id_registro, motivo, valor) over all rules."""
    return reduce(DataFrame.unionByName, rejects)


def broken_rows(df: DataFrame, table: str, key: str, broken: str) -> DataFrame:
    """Error rows of the broken lines of a staging read, with their text; an unreadable key is NULL."""
    return df.select(
        F.lit(table).alias("tabla"), F.col(key).try_cast("bigint").alias("id_registro"),
        F.lit(BROKEN_LINE).alias("motivo"), F.lit(None).cast("double").alias("valor"), F.col(broken).alias("texto"))


def error_log_with_text(log: DataFrame, *broken: DataFrame) -> DataFrame:
    """The error log and the broken lines; ``texto`` is NULL where a rule refused a whole line."""
    return reduce(DataFrame.unionByName, broken, log.withColumn("texto", F.lit(None).cast("string")))


def line_account(text_lines: DataFrame, staging: DataFrame, broken: str) -> DataFrame:
    """(leidas, enteras, rotas, vacias, cuadra): every line of the files is whole, broken or empty."""
    blank = F.length(F.trim("value")) == 0
    read = text_lines.agg(F.count(F.lit(1)).alias("leidas"), F.lit(0).alias("enteras"), F.lit(0).alias("rotas"), F.count_if(blank).alias("vacias"))
    parsed = staging.agg(F.lit(0).alias("leidas"), F.count_if(F.col(broken).isNull()).alias("enteras"),
                         F.count_if(F.col(broken).isNotNull()).alias("rotas"), F.lit(0).alias("vacias"))
    sums = read.unionByName(parsed).agg(*[F.sum(c).alias(c) for c in read.columns])
    return sums.withColumn("cuadra", F.col("leidas") == F.col("enteras") + F.col("rotas") + F.col("vacias"))


def quality_summary(stages: Sequence[tuple[str, Mapping[str, Column], DataFrame]]) -> DataFrame:
    """(tabla, regla, registros_afectados): one pass per table for all its rules."""
    parts = []
    for table, rules, df in stages:
        cells = [F.struct(F.lit(rule).alias("regla"), F.coalesce(c, F.lit(0)).cast("bigint").alias("registros_afectados"))
                 for rule, c in rules.items()]
        parts.append(df.agg(F.array(*cells).alias("s")).select(F.lit(table).alias("tabla"), F.inline("s")))
    return reduce(DataFrame.unionByName, parts)


def typed_orders(staging: DataFrame, order: Sequence[str], load_date: dt.date) -> DataFrame:
    """Staged text -> deduplicated, typed orders carrying their rule flags."""
    first = windows.dedupe_first(staging, ["id_pedido"], order)
    flagged = impute_date(impute_customer(first), load_date)
    return flagged.select(
        F.col("id_pedido").try_cast("bigint").alias("id_pedido"),
        "fecha_pedido",
        "hora_pedido",
        "id_cliente",
        F.col("id_empleado").try_cast("bigint").alias("id_empleado"),
        "canal_interno",
        "metodo_pago",
        text.safe_cast(F.col("monto_total"), "decimal(12,2)").alias("monto_total"),
        "fecha_imputada",
        "es_paso",
    )


def typed_lines(staging: DataFrame) -> DataFrame:
    casts = {"id_detalle": "bigint", "id_pedido": "bigint", "id_plato": "bigint", "cantidad": "int",
             "precio_unitario": "decimal(12,2)", "subtotal": "decimal(12,2)"}
    return staging.select(*[text.safe_cast(F.col(c), t).alias(c) for c, t in casts.items()])


def load_orders(staging: DataFrame, staging_lines: DataFrame, order: Sequence[str],
                load_date: dt.date) -> dict[str, DataFrame]:
    """The bulk order load: accepted orders and lines, error log, quality summary.

    The deduplicated orders feed every output, so they are staged once.
    """
    orders = stage(typed_orders(staging, order, load_date), "pedidos")
    lines = typed_lines(staging_lines)
    ok, bad = reject_amount(orders)
    kept, orphans = reject_orphans(lines, ok)
    accepted = ok.drop("es_paso")
    errors = error_log(
        error_rows(bad, "Pedido", "id_pedido", BAD_AMOUNT, "monto_total"),
        error_rows(orphans, "Detalle_Pedido", "id_detalle", ORPHAN_LINE, "subtotal"))
    summary = quality_summary([
        ("Pedido", {"R1 duplicados descartados": F.sum(F.col("n") - 1)},
         staging.groupBy("id_pedido").agg(F.count(F.lit(1)).alias("n"))),
        ("Pedido", {
            "R2 id_cliente NULL -> 9999": F.sum("es_paso"),
            "R3 fecha inválida -> fecha de carga": F.sum("fecha_imputada"),
            "R4 monto <= 0 rechazado": F.count_if(bad_amount(F.col("monto_total"))),
        }, orders),
        ("Detalle_Pedido", {"R6 huérfanos rechazados": F.count(F.lit(1))}, orphans),
    ])
    return {"pedidos": accepted, "detalle": kept, "errores": errors, "calidad": summary}


def load_counters(staging: DataFrame, staging_lines: DataFrame, order: Sequence[str], load_date: dt.date) -> DataFrame:
    """The seven counters of the bulk order load, one row; staged orders and lines are read once each."""
    orders = stage(typed_orders(staging, order, load_date), "pedidos")
    bad = bad_amount(F.col("monto_total"))
    ok = orders.filter(~bad).select("id_pedido", F.lit(1).alias("_ok"))
    lines = typed_lines(staging_lines).select("id_pedido").join(ok, "id_pedido", "left")
    parts = [
        windows.discarded_count(staging, ["id_pedido"]).select(F.col("descartados").alias("dup")),
        orders.agg(F.count_if(~bad).alias("ins_pedidos"), F.sum("es_paso").alias("cliente_paso"),
                   F.sum("fecha_imputada").alias("fecha_imputada"), F.count_if(bad).alias("monto_rechazado")),
        lines.agg(F.count("_ok").alias("ins_detalle"), F.count_if(F.col("_ok").isNull()).alias("huerfanos")),
    ]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in (
        "ins_pedidos", "ins_detalle", "dup", "cliente_paso", "fecha_imputada", "monto_rechazado", "huerfanos")])


def client_counters(staging: DataFrame, order: Sequence[str]) -> DataFrame:
    """(insertados, duplicados, dni_invalidos) of the bulk client load, one row."""
    first = windows.dedupe_first(staging, ["id_cliente"], order).agg(
        F.count(text.safe_cast(F.col("id_cliente"), "bigint")).alias("insertados"),
        F.count_if(~text.is_valid_id(F.col("dni"))).alias("dni_invalidos"))
    repeats = windows.discarded_count(staging, ["id_cliente"]).select(F.col("descartados").alias("duplicados"))
    return first.unionByName(repeats, allowMissingColumns=True).agg(*[
        F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("insertados", "duplicados", "dni_invalidos")])


def load_clients(staging: DataFrame, order: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """The bulk client load: R1, R5, blanks to NULL, plus the walk-in member if absent."""
    first = windows.dedupe_first(staging, ["id_cliente"], order)
    typed = null_invalid_id(first, "dni").select(
        text.safe_cast(F.col("id_cliente"), "bigint").alias("id_cliente"),
        "dni", "nombre", "apellido",
        text.blank_to_null(F.col("email")).alias("email"),
        text.blank_to_null(F.col("telefono")).alias("telefono"),
        "distrito", "tipo_cliente",
        calendar.safe_date(F.col("fecha_registro")).alias("fecha_registro"),
    ).filter(F.col("id_cliente").isNotNull())
    if existing is not None:
        typed = typed.unionByName(existing.select(*typed.columns))
    member = literal_rows(
        staging.sparkSession, [(WALK_IN, None, "CLIENTE", "DE PASO", None, None, "N/A", "Nuevo", dt.date(2025, 6, 1))],
        "id_cliente bigint, dni string, nombre string, apellido string, email string, "
        "telefono string, distrito string, tipo_cliente string, fecha_registro date")
    absent = member.join(typed.filter(F.col("id_cliente") == WALK_IN).select("id_cliente").limit(1),
                         "id_cliente", "left_anti")
    return typed.unionByName(absent)


def check_fk(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """(columna, faltantes): rows whose key the dimension lacks."""
    return joins.missing_keys(df, column, dim, key).agg(
        F.lit(column).alias("columna"), F.count(F.lit(1)).alias("faltantes"))


def check_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return stats.null_counts(df, columns)


def require_zero(report: DataFrame, column: str, message: str) -> None:
    """Stop the run when any row of a check report is above zero."""
    if not report.filter(F.col(column) > 0).isEmpty():
        raise ValidationError(message)


def reconcile_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders whose total differs from the sum of their lines; no lines counts as a difference."""
    sums = lines.groupBy("id_pedido").agg(F.bround(F.sum("subtotal"), 2).alias("suma_det"))
    joined = orders.join(sums, "id_pedido", "left")
    equal = F.bround(F.col("monto_total"), 2) == F.col("suma_det")
    return joined.filter(~F.coalesce(equal, F.lit(False))).select("id_pedido", "monto_total", "suma_det")


def impute_price(feed: DataFrame, catalog: DataFrame) -> DataFrame:
    """Missing gross price = base price x quantity x 1.10, half-even; ``precio_imputado`` flags it."""
    named = joins.lookup_normalised(feed, catalog, "plato", "nombre_plato", "id_plato", "precio_base")
    filled = F.bround(F.col("precio_base") * F.col("cantidad") * F.lit(1.10).cast("decimal(3,2)"), 2)
    return named.withColumns({
        "precio_imputado": F.col("precio_bruto").isNull().cast("int"),
        "precio_bruto": F.coalesce("precio_bruto", filled).cast(money.MONEY),
    })


def check_mapped(feed: DataFrame, catalog: DataFrame) -> DataFrame:
    """(sin_mapear, normalizados): names without a dish, names the catalog spells differently."""
    named = joins.lookup_normalised(feed, catalog, "plato", "nombre_plato")
    return named.agg(
        F.count_if(F.col("nombre_plato").isNull()).alias("sin_mapear"),
        F.count_if(F.col("plato") != F.col("nombre_plato")).alias("normalizados"))


def profile_feed(feed: DataFrame) -> DataFrame:
    """Rows, repeated refs, missing prices, missing ratings.

    The refs are counted per ref first, so one pass gives all four numbers.
    """
    per_ref = feed.groupBy("order_ref").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("precio_bruto").isNull()).alias("p"),
        F.count_if(F.col("calificacion").isNull()).alias("c"))
    return per_ref.agg(
        F.sum("n").alias("filas"), F.sum(F.col("n") - 1).alias("dup_order_ref"),
        F.sum("p").alias("precio_nulo"), F.sum("c").alias("calif_nula"))


def check_domain(df: DataFrame, rules: Mapping[str, Column], unique: Sequence[str] = ()) -> DataFrame:
    """(regla, violaciones): rows where a rule is false (NULL passes, as in CHECK), and repeated keys."""
    report = None
    if rules:
        cells = [F.struct(F.lit(name).alias("regla"), F.count_if(~rule).alias("violaciones"))
                 for name, rule in rules.items()]
        report = df.agg(F.array(*cells).alias("s")).select(F.inline("s"))
    for column in unique:
        repeated = windows.discarded_count(df, [column]).select(
            F.lit(f"UNIQUE {column}").alias("regla"), F.col("descartados").alias("violaciones"))
        report = repeated if report is None else report.unionByName(repeated)
    return report


def check_ranges(df: DataFrame, rules: Mapping[str, tuple[Column, object, object]]) -> DataFrame:
    """(criterio, fuera, sin_valor): values outside [low, high] and NULLs, in one pass.

    A bound of None is open.
    """
    cells = []
    for name, (c, low, high) in rules.items():
        inside = F.lit(True)
        if low is not None:
            inside = inside & (c >= low)
        if high is not None:
            inside = inside & (c <= high)
        cells.append(F.struct(F.lit(name).alias("criterio"), F.count_if(~inside).alias("fuera"),
                              F.count_if(c.isNull()).alias("sin_valor")))
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def line_mismatch() -> Column:
    return money.differs(F.col("subtotal"), F.col("cantidad") * F.col("precio_unitario"))


def validate_lines(lines: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """|subtotal - qty x price| > 0.01 refuses the batch (``fail``) or sets the line aside."""
    good, bad = lines.filter(~line_mismatch()), lines.filter(line_mismatch())
    if mode == "fail" and not bad.isEmpty():
        raise ValidationError(BLOCKED_LINES)
    return good, bad


def amount_report(orders: DataFrame) -> DataFrame:
    """(accion, tabla_afectada, valor_anterior, valor_nuevo) of a blocked batch; empty when all is well."""
    bad = orders.filter(F.col("monto_total") <= 0)
    n = bad.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(None).cast("string").alias("ids"))
    ids = stats.joined_ids(bad, "id_pedido").select(F.lit(None).cast("bigint").alias("n"), "ids")
    return n.unionByName(ids).agg(F.max("n").alias("n"), F.max("ids").alias("ids")).filter("n > 0").select(
        F.concat(F.lit("Intento bloqueado: monto_total <= 0 ("), F.col("n").cast("string"), F.lit(" fila/s)")).alias("accion"),
        F.lit("Pedido").alias("tabla_afectada"),
        F.lit(None).cast("string").alias("valor_anterior"),
        F.col("ids").alias("valor_nuevo"))


def validate_amounts(orders: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Amounts <= 0 refuse the batch with their count and ids, or are set aside."""
    bad = F.coalesce(F.col("monto_total") <= 0, F.lit(False))
    if mode == "fail":
        report = amount_report(orders).first()
        if report is not None:
            raise ValidationError(f"{report.accion}: {report.valor_nuevo}")
    return orders.filter(~bad), orders.filter(bad)


class StepLog:
    """The step log of an ETL run, counted by the run itself.

    Every frame that passes through ``before``, ``after`` or ``step`` counts its
    rows while the run's own jobs read it (``DataFrame.observe``); nothing is
    evaluated again for the log.  ``rows`` belongs after those jobs: it waits for
    the counters of every named frame, so each must be part of what was run, and
    of one job's plan only.  A range partitioning above it would read it twice
    (it samples first) and count it twice: write such a frame first.  Rows come in
    the order in which steps were named.  A stage that is computed again after a
    lost executor counts its rows again: the log tells what the run read, the
    tables what they hold.
    """

    COUNTERS = ("filas_in", "filas_out", "filas_afectadas")
    SCHEMA = "paso string, descripcion string, filas_in bigint, filas_out bigint, filas_afectadas bigint"

    def __init__(self) -> None:
        self._steps: dict[str, str] = {}
        self._seen: list[tuple[str, Observation]] = []

    def _watch(self, step: str, description: str, df: DataFrame, **counters: Column) -> DataFrame:
        if self._steps.setdefault(step, description) != description:
            raise ValueError(f"step {step} has two descriptions")
        counted = [F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in counters.items()]
        seen = Observation(f"{step}-{len(self._seen)}")
        self._seen.append((step, seen))
        return df.observe(seen, *counted)

    def before(self, step: str, description: str, df: DataFrame) -> DataFrame:
        """``df`` as what ``step`` takes."""
        return self._watch(step, description, df, filas_in=F.count(F.lit(1)))

    def after(self, step: str, description: str, df: DataFrame, affected: Column | None = None) -> DataFrame:
        """``df`` as what ``step`` gives; ``affected`` is an aggregate over it."""
        extra = {} if affected is None else {"filas_afectadas": affected}
        return self._watch(step, description, df, filas_out=F.count(F.lit(1)), **extra)

    def step(self, step: str, description: str, df: DataFrame, affected: Column | None = None) -> DataFrame:
        """``df`` as what a step takes and gives that neither adds nor drops a row."""
        extra = {} if affected is None else {"filas_afectadas": affected}
        return self._watch(step, description, df, filas_in=F.count(F.lit(1)), filas_out=F.count(F.lit(1)), **extra)

    def rows(self, spark: SparkSession) -> DataFrame:
        """(paso, descripcion, filas_in, filas_out, filas_afectadas, marca_tiempo), one row per step."""
        found = {step: dict.fromkeys(self.COUNTERS, 0) for step in self._steps}
        for step, seen in self._seen:
            found[step].update(seen.get)
        rows = [(step, self._steps[step], *[counted[c] for c in self.COUNTERS]) for step, counted in found.items()]
        return spark.createDataFrame(rows, self.SCHEMA).withColumn("marca_tiempo", F.current_timestamp())
