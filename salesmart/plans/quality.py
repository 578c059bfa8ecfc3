"""Load rules and checks on dirtied inputs: Q1-Q23."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import money
from ..operators import copies, intake, quality, stats, warehouse, windows
from ..session import stage
from ..sources.tables import Tables
from . import bindings as b
from .registry import query

# Deduplicated, typed staging orders in SQL.
TYPED = f"""ped AS (SELECT CAST(id_pedido AS BIGINT) AS id_pedido,
      coalesce(CAST(try_strptime(fecha_pedido, '%d/%m/%Y') AS DATE), DATE '{b.LOAD_DATE}') AS fecha_pedido,
      CAST(try_strptime(fecha_pedido, '%d/%m/%Y') IS NULL AS INT) AS fecha_imputada, hora_pedido,
      coalesce(TRY_CAST(nullif(id_cliente, '') AS BIGINT), 9999) AS id_cliente, CAST(nullif(id_cliente, '') IS NULL AS INT) AS es_paso,
      CAST(id_empleado AS BIGINT) AS id_empleado, canal_interno, metodo_pago, TRY_CAST(monto_total AS DECIMAL(12,2)) AS monto_total
    FROM (SELECT *, row_number() OVER (PARTITION BY id_pedido ORDER BY copia) AS rn FROM stg_pedido) WHERE rn = 1)"""
ACCEPTED = TYPED + ", ok AS (SELECT * FROM ped WHERE monto_total > 0)"
LINES = ("lin AS (SELECT CAST(id_detalle AS BIGINT) AS id_detalle, CAST(id_pedido AS BIGINT) AS id_pedido, CAST(id_plato AS BIGINT) AS id_plato, "
         "CAST(cantidad AS INT) AS cantidad, CAST(precio_unitario AS DECIMAL(12,2)) AS precio_unitario, CAST(subtotal AS DECIMAL(12,2)) AS subtotal FROM stg_detalle)")
ERRORS = ACCEPTED + ", " + LINES + f""", err AS (
    SELECT 'Pedido' AS tabla, id_pedido AS id_registro, '{quality.BAD_AMOUNT}' AS motivo, monto_total::DOUBLE AS valor FROM ped WHERE monto_total IS NULL OR monto_total <= 0
    UNION ALL SELECT 'Detalle_Pedido', id_detalle, '{quality.ORPHAN_LINE}', subtotal::DOUBLE FROM lin WHERE id_pedido NOT IN (SELECT id_pedido FROM ok))"""


def _load(t: Tables):
    return quality.load_orders(b.stg_pedido(t), b.stg_detalle(t), b.FIRST, b.LOAD_DATE)


def _typed(t: Tables):
    return quality.typed_orders(b.stg_pedido(t), b.FIRST, b.LOAD_DATE)


@query("q01_dedupe", b.sql("stg_pedido", """
    SELECT id_pedido, monto_total FROM (SELECT *, row_number() OVER (PARTITION BY id_pedido ORDER BY copia) AS rn FROM stg_pedido) WHERE rn = 1"""))
def _(t: Tables):
    return windows.dedupe_first(b.stg_pedido(t), ["id_pedido"], b.FIRST).select("id_pedido", "monto_total")


@query("q01_discarded", b.sql("stg_pedido", "SELECT count(*) - count(DISTINCT id_pedido) AS descartados FROM stg_pedido"))
def _(t: Tables):
    return windows.discarded_count(b.stg_pedido(t), ["id_pedido"])


@query("q02_impute_customer", b.sql("stg_pedido", f"WITH {TYPED} SELECT id_pedido, id_cliente, es_paso FROM ped"))
def _(t: Tables):
    return _typed(t).select("id_pedido", "id_cliente", "es_paso")


@query("q03_impute_date", b.sql("stg_pedido", f"WITH {TYPED} SELECT id_pedido, fecha_pedido, fecha_imputada FROM ped"))
def _(t: Tables):
    return _typed(t).select("id_pedido", "fecha_pedido", "fecha_imputada")


@query("q04_accepted", b.sql("stg_pedido", f"WITH {ACCEPTED} SELECT id_pedido, monto_total::DOUBLE AS monto_total FROM ok"))
def _(t: Tables):
    return quality.reject_amount(_typed(t))[0].select("id_pedido", "monto_total")


@query("q04_rejected", b.sql("stg_pedido", f"WITH {TYPED} SELECT id_pedido, monto_total::DOUBLE AS monto_total FROM ped WHERE monto_total IS NULL OR monto_total <= 0"))
def _(t: Tables):
    return quality.reject_amount(_typed(t))[1].select("id_pedido", "monto_total")


@query("q05_null_invalid_id", b.sql("stg_cliente", """
    SELECT id_cliente, copia, CASE WHEN regexp_full_match(dni, '[0-9]{8}') THEN dni END AS dni FROM stg_cliente"""))
def _(t: Tables):
    return quality.null_invalid_id(b.stg_cliente(t), "dni").select("id_cliente", "copia", "dni")


@query("q06_orphans", b.sql("stg_pedido stg_detalle", f"""
    WITH {ACCEPTED}, {LINES} SELECT id_detalle, id_pedido, subtotal::DOUBLE AS subtotal FROM lin WHERE id_pedido NOT IN (SELECT id_pedido FROM ok)"""))
def _(t: Tables):
    ok, _bad = quality.reject_amount(_typed(t))
    return quality.reject_orphans(quality.typed_lines(b.stg_detalle(t)), ok)[1].select("id_detalle", "id_pedido", "subtotal")


@query("q06_kept_lines", b.sql("stg_pedido stg_detalle", f"""
    WITH {ACCEPTED}, {LINES} SELECT id_detalle, id_pedido, subtotal::DOUBLE AS subtotal FROM lin WHERE id_pedido IN (SELECT id_pedido FROM ok)"""))
def _(t: Tables):
    ok, _bad = quality.reject_amount(_typed(t))
    return quality.reject_orphans(quality.typed_lines(b.stg_detalle(t)), ok)[0].select("id_detalle", "id_pedido", "subtotal")


@query("q07_fact_fk", b.sql("fact_ventas " + " ".join(warehouse.FACT_KEYS.values()), " UNION ALL ".join(
    f"SELECT '{key}' AS columna, count(*) AS faltantes FROM fact_ventas WHERE {key} NOT IN (SELECT {key} FROM {dim})"
    for key, dim in warehouse.FACT_KEYS.items())))
def _(t: Tables):
    tables = b.star(t)
    return reduce(DataFrame.unionByName, [
        quality.check_fk(tables["fact_ventas"], key, tables[dim], key) for key, dim in warehouse.FACT_KEYS.items()])


@query("q08_reconcile", b.sql("pedidos detalle", """
    SELECT id_pedido, monto_total::DOUBLE AS monto_total, s::DOUBLE AS suma_det FROM pedidos
    LEFT JOIN (SELECT id_pedido, sum(subtotal) AS s FROM detalle GROUP BY 1) USING (id_pedido) WHERE s IS NULL OR s <> monto_total"""))
def _(t: Tables):
    return quality.reconcile_totals(b.pedidos(t), b.detalle(t))


KEYS = list(warehouse.FACT_KEYS)


@query("q09_no_null_keys", b.sql("fact_ventas", " UNION ALL ".join(
    f"SELECT '{k}' AS columna, count(*) FILTER (WHERE {k} IS NULL) AS nulos FROM fact_ventas" for k in KEYS)))
def _(t: Tables):
    return quality.check_no_nulls(b.star(t)["fact_ventas"], KEYS)


@query("q10_error_log", b.sql("stg_pedido stg_detalle", f"WITH {ERRORS} SELECT * FROM err"))
def _(t: Tables):
    return _load(t)["errores"]


SUMMARY = """
    SELECT 'Pedido' AS tabla, 'R1 duplicados descartados' AS regla, count(*) - count(DISTINCT id_pedido) AS registros_afectados FROM stg_pedido
    UNION ALL SELECT 'Pedido', 'R2 id_cliente NULL -> 9999', CAST(sum(es_paso) AS BIGINT) FROM ped
    UNION ALL SELECT 'Pedido', 'R3 fecha inválida -> fecha de carga', CAST(sum(fecha_imputada) AS BIGINT) FROM ped
    UNION ALL SELECT 'Pedido', 'R4 monto <= 0 rechazado', count(*) FROM ped WHERE monto_total IS NULL OR monto_total <= 0
    UNION ALL SELECT 'Detalle_Pedido', 'R6 huérfanos rechazados', count(*) FROM lin WHERE id_pedido NOT IN (SELECT id_pedido FROM ok)"""


@query("q11_quality_summary", b.sql("stg_pedido stg_detalle", f"WITH {ACCEPTED}, {LINES} {SUMMARY}"))
def _(t: Tables):
    return _load(t)["calidad"]


@query("q12_step_log", b.sql("feed clean_feed clientes dim_plato", """
    SELECT 'T01' AS paso, (SELECT count(*) FROM feed) AS filas_in, (SELECT count(*) FROM clean_feed) AS filas_out, 0 AS filas_afectadas
    UNION ALL SELECT 'T02', count(*), count(*), count(*) FILTER (WHERE plato <> nombre_plato) FROM clean_feed
    UNION ALL SELECT 'T03', count(*), count(*), CAST(sum(precio_imputado) AS BIGINT) FROM clean_feed
    UNION ALL SELECT 'T05', count(*), count(*), count(dni) FROM clientes
    UNION ALL SELECT 'L03', (SELECT count(*) FROM part), count(*), count(*) FROM dim_plato"""))
def _(t: Tables):
    log = quality.StepLog()
    names = F.count_if(F.col("plato") != F.col("nombre_plato"))
    raw = log.before("T01", "Eliminar duplicados por order_ref", b.feed(t))
    clean = log.after("T01", "Eliminar duplicados por order_ref", warehouse.clean_feed(raw, b.platos(t), b.FIRST))
    clean = log.step("T02", "Normalizar nombre de plato contra catálogo", clean, names)
    clean = log.step("T03", "Imputar precio_bruto nulo", clean, F.sum("precio_imputado"))
    people = log.step("T05", "Seudonimizar DNI", b.clientes(t), F.count("dni"))
    dishes = log.after("L03", "Construir Dim_Plato", log.before("L03", "Construir Dim_Plato", b.platos(t)), F.count(F.lit(1)))
    # The run: each source is read once, to be written; keys are dealt out afterwards, as that samples its input.
    stage(clean, "feed")
    warehouse.build_dim_customer(stage(people, "clientes"), b.AS_OF, b.SALT)
    warehouse.build_dim_dish(stage(dishes, "platos"))
    return log.rows(t.spark).drop("marca_tiempo", "descripcion")


@query("q13_impute_price", b.sql("feed platos", f"""
    SELECT order_ref, copia, CAST(precio_bruto IS NULL AS INT) AS precio_imputado,
      coalesce(precio_bruto, round_even(precio_base * cantidad * 1.10, 2))::DOUBLE AS precio_bruto
    FROM feed f LEFT JOIN platos p ON {b._NORM.format('p.nombre_plato')} = {b._NORM.format('f.plato')}"""))
def _(t: Tables):
    return quality.impute_price(b.feed(t), b.platos(t)).select("order_ref", "copia", "precio_imputado", "precio_bruto")


@query("q14_check_mapped", b.sql("feed platos", f"""
    SELECT count(*) FILTER (WHERE nombre_plato IS NULL) AS sin_mapear, count(*) FILTER (WHERE plato <> nombre_plato) AS normalizados
    FROM (SELECT CASE WHEN event_no % 301 = 0 THEN 'desconocido' ELSE plato END AS plato FROM (SELECT *, fila AS event_no FROM feed)) f
    LEFT JOIN platos p ON {b._NORM.format('p.nombre_plato')} = {b._NORM.format('f.plato')}"""))
def _(t: Tables):
    feed = b.feed(t).withColumn("plato", F.expr("CASE WHEN fila % 301 = 0 THEN 'desconocido' ELSE plato END"))
    return quality.check_mapped(feed, b.platos(t))


@query("q15_permitted_nulls", b.sql("clientes empleados", """
    SELECT 'email' AS columna, count(*) FILTER (WHERE email IS NULL) AS nulos FROM clientes
    UNION ALL SELECT 'salario_mensual', count(*) FILTER (WHERE salario_mensual IS NULL) FROM empleados"""))
def _(t: Tables):
    return stats.null_counts(b.clientes(t), ["email"]).unionByName(stats.null_counts(b.empleados(t), ["salario_mensual"]))


@query("q16_profile_feed", b.sql("feed", """
    SELECT count(*) AS filas, count(*) - count(DISTINCT order_ref) AS dup_order_ref, count(*) FILTER (WHERE precio_bruto IS NULL) AS precio_nulo,
      count(*) FILTER (WHERE calificacion IS NULL) AS calif_nula FROM feed"""))
def _(t: Tables):
    return quality.profile_feed(b.feed(t))


@query("q17_load_clients", b.sql("stg_cliente", """
    SELECT TRY_CAST(id_cliente AS BIGINT) AS id_cliente, CASE WHEN regexp_full_match(dni, '[0-9]{8}') THEN dni END AS dni, nombre, apellido,
      nullif(email, '') AS email, nullif(telefono, '') AS telefono, distrito, tipo_cliente,
      CAST(try_strptime(fecha_registro, '%d/%m/%Y') AS DATE) AS fecha_registro
    FROM (SELECT *, row_number() OVER (PARTITION BY id_cliente ORDER BY copia) AS rn FROM stg_cliente) WHERE rn = 1 AND TRY_CAST(id_cliente AS BIGINT) IS NOT NULL
    UNION ALL SELECT 9999, NULL, 'CLIENTE', 'DE PASO', NULL, NULL, 'N/A', 'Nuevo', DATE '2025-06-01'
      WHERE NOT EXISTS (SELECT 1 FROM stg_cliente WHERE TRY_CAST(id_cliente AS BIGINT) = 9999)"""))
def _(t: Tables):
    return quality.load_clients(b.stg_cliente(t), b.FIRST)


@query("q18_check_domain", b.sql("pedidos detalle", """
    SELECT 'canal_interno' AS regla, count(*) FILTER (WHERE canal_interno NOT IN ('Salón','Para llevar')) AS violaciones FROM pedidos
    UNION ALL SELECT 'metodo_pago', count(*) FILTER (WHERE metodo_pago NOT IN ('Efectivo','Yape','Plin','Tarjeta')) FROM pedidos
    UNION ALL SELECT 'monto_total', count(*) FILTER (WHERE NOT monto_total > 50000) FROM pedidos
    UNION ALL SELECT 'UNIQUE id_detalle', count(*) - count(DISTINCT id_detalle) FROM detalle"""))
def _(t: Tables):
    rules = {
        "canal_interno": F.col("canal_interno").isin("Salón", "Para llevar"),
        "metodo_pago": F.col("metodo_pago").isin("Efectivo", "Yape", "Plin", "Tarjeta"),
        "monto_total": F.col("monto_total") > 50000,
    }
    return quality.check_domain(b.pedidos(t), rules).unionByName(quality.check_domain(b.detalle(t), {}, ["id_detalle"]))


@query("q19_bad_lines", b.sql("detalle", """
    SELECT id_detalle, subtotal::DOUBLE AS subtotal FROM detalle WHERE abs(subtotal - cantidad * precio_unitario) > 0.01"""))
def _(t: Tables):
    return quality.validate_lines(b.detalle(t))[1].select("id_detalle", "subtotal")


@query("q20_blocked_amounts", b.sql("stg_pedido", f"""
    WITH {TYPED} SELECT 'Intento bloqueado: monto_total <= 0 (' || count(*) || ' fila/s)' AS accion, 'Pedido' AS tabla_afectada,
      NULL::VARCHAR AS valor_anterior, left(string_agg(id_pedido::VARCHAR, ',' ORDER BY id_pedido), 200) AS valor_nuevo FROM ped WHERE monto_total <= 0"""))
def _(t: Tables):
    return quality.amount_report(_typed(t))


INTAKE = """
    req AS (SELECT id_detalle, id_pedido, CASE WHEN id_detalle % 19 = 0 OR id_pedido % 31 = 0 THEN -1 ELSE id_plato END AS id_plato,
      CASE WHEN id_detalle % 23 = 0 THEN 0 ELSE cantidad END AS cantidad FROM detalle),
    priced AS (SELECT r.*, precio_base, CASE WHEN precio_base IS NULL THEN 'Plato inexistente' WHEN cantidad <= 0 THEN 'cantidad <= 0' END AS motivo,
      CAST(cantidad * precio_base AS DECIMAL(12,2)) AS subtotal FROM req r LEFT JOIN platos USING (id_plato)),
    acc AS (SELECT id_pedido, sum(subtotal) AS monto_total FROM priced WHERE motivo IS NULL GROUP BY 1 HAVING sum(subtotal) > 0)"""


def _intake(t: Tables):
    lines = b.detalle(t).selectExpr(
        "id_detalle", "id_pedido", "CASE WHEN id_detalle % 19 = 0 OR id_pedido % 31 = 0 THEN -1 ELSE id_plato END AS id_plato",
        "CASE WHEN id_detalle % 23 = 0 THEN 0 ELSE cantidad END AS cantidad")
    orders = b.pedidos(t).selectExpr("id_pedido", "nullif(id_cliente, 9999) AS id_cliente", "id_empleado", "canal_interno", "metodo_pago")
    return intake.intake_orders(orders, lines, b.platos(t))


@query("q21_intake_orders", b.sql("pedidos detalle platos", f"WITH {INTAKE} SELECT id_pedido, id_cliente, a.monto_total::DOUBLE AS monto_total FROM pedidos p JOIN acc a USING (id_pedido)"))
def _(t: Tables):
    return _intake(t)[0].select("id_pedido", "id_cliente", "monto_total")


@query("q21_intake_lines", b.sql("pedidos detalle platos", f"""
    WITH {INTAKE} SELECT id_detalle, id_pedido, id_plato, cantidad, precio_base::DOUBLE AS precio_unitario, subtotal::DOUBLE AS subtotal
    FROM priced WHERE motivo IS NULL AND id_pedido IN (SELECT id_pedido FROM acc)"""))
def _(t: Tables):
    return _intake(t)[1]


@query("q21_intake_errors", b.sql("pedidos detalle platos", f"""
    WITH {INTAKE} SELECT 'Detalle_Pedido' AS tabla, id_detalle AS id_registro, motivo FROM priced WHERE motivo IS NOT NULL AND id_pedido IN (SELECT id_pedido FROM acc)
    UNION ALL SELECT 'Pedido', id_pedido, 'El pedido no tiene líneas válidas' FROM pedidos WHERE id_pedido NOT IN (SELECT id_pedido FROM acc)"""))
def _(t: Tables):
    return _intake(t)[2]


# A copy of the orders in which, in every fiftieth block of 64 ids, the first and the last order have swapped their amounts.
COPIES = """copia AS (SELECT *, o_orderkey // 64 AS bloque, min(o_orderkey) OVER w AS primero, max(o_orderkey) OVER w AS ultimo FROM orders
      WINDOW w AS (PARTITION BY o_orderkey // 64)),
    otra AS (SELECT c.* REPLACE (CASE WHEN c.bloque % 50 = 0 AND c.o_orderkey = c.primero THEN u.o_totalprice
        WHEN c.bloque % 50 = 0 AND c.o_orderkey = c.ultimo THEN p.o_totalprice ELSE c.o_totalprice END AS o_totalprice)
      FROM copia c JOIN orders p ON p.o_orderkey = c.primero JOIN orders u ON u.o_orderkey = c.ultimo)"""
_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _swapped(t: Tables) -> DataFrame:
    block = Window.partitionBy(F.expr("o_orderkey div 64")).orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = t.orders.withColumns({
        "primero": F.first("o_orderkey").over(block), "ultimo": F.last("o_orderkey").over(block),
        "monto_primero": F.first("o_totalprice").over(block), "monto_ultimo": F.last("o_totalprice").over(block)})
    swap = F.expr("(o_orderkey div 64) % 50 = 0")
    amount = F.when(swap & (F.col("o_orderkey") == F.col("primero")), F.col("monto_ultimo")).when(
        swap & (F.col("o_orderkey") == F.col("ultimo")), F.col("monto_primero")).otherwise(F.col("o_totalprice"))
    return ends.withColumn("o_totalprice", amount).select(*t.orders.columns)


@query("q22_compare_copies", f"""WITH {COPIES},
    c AS (SELECT {_ORDER} FROM orders), d AS (SELECT {_ORDER} FROM otra),
    x AS (SELECT count(*) AS n FROM ((SELECT * FROM c EXCEPT ALL SELECT * FROM d) UNION ALL (SELECT * FROM d EXCEPT ALL SELECT * FROM c))),
    e AS (SELECT count(*) AS n FROM (SELECT * FROM c EXCEPT ALL SELECT * FROM c))
    SELECT 'cambiada' AS copia, (SELECT count(*) FROM c) AS filas_a, (SELECT count(*) FROM d) AS filas_b,
      CAST((SELECT count(*) FROM c) = (SELECT count(*) FROM d) AS INT) AS filas_iguales, CAST(n = 0 AS INT) AS contenido_igual FROM x
    UNION ALL SELECT 'igual', (SELECT count(*) FROM c), (SELECT count(*) FROM c), CAST((SELECT count(*) FROM c) = (SELECT count(*) FROM c) AS INT), CAST(n = 0 AS INT) FROM e""")
def _(t: Tables):
    changed = copies.compare_copies(t.orders, _swapped(t)).withColumn("copia", F.lit("cambiada"))
    return changed.unionByName(copies.compare_copies(t.orders, t.orders.repartition("o_custkey")).withColumn("copia", F.lit("igual")))


@query("q22_differing_rows", f"""WITH {COPIES}, c AS (SELECT {_ORDER} FROM orders), d AS (SELECT {_ORDER} FROM otra)
    SELECT o_orderkey, o_totalprice, 'a' AS lado, count(*) AS veces FROM (SELECT * FROM c EXCEPT ALL SELECT * FROM d) GROUP BY 1, 2
    UNION ALL SELECT o_orderkey, o_totalprice, 'b', count(*) FROM (SELECT * FROM d EXCEPT ALL SELECT * FROM c) GROUP BY 1, 2""")
def _(t: Tables):
    return copies.diff_copies(t.orders, _swapped(t)).select("o_orderkey", "o_totalprice", "lado", "veces")


@query("q23_check_ranges", b.sql("lines", """
    SELECT 'comision entre 1 % y 8 %' AS criterio, count(*) FILTER (WHERE comision_plataforma / importe_bruto NOT BETWEEN 0.01 AND 0.08) AS fuera,
      count(*) FILTER (WHERE comision_plataforma IS NULL) AS sin_valor FROM lines WHERE origen = 'CSV externo'
    UNION ALL SELECT 'calificacion 1-5', count(*) FILTER (WHERE calificacion NOT BETWEEN 1 AND 5), count(*) FILTER (WHERE calificacion IS NULL) FROM lines WHERE origen = 'CSV externo'
    UNION ALL SELECT 'entrega 12-80 min', count(*) FILTER (WHERE tiempo_entrega_min NOT BETWEEN 12 AND 80), count(*) FILTER (WHERE tiempo_entrega_min IS NULL) FROM lines WHERE origen = 'CSV externo'
    UNION ALL SELECT 'importe >= 0', count(*) FILTER (WHERE importe_bruto < 0), 0 FROM lines WHERE origen = 'CSV externo'"""))
def _(t: Tables):
    apps = b.lines(t).filter("origen = 'CSV externo'")
    share = money.ratio(F.col("comision_plataforma"), F.col("importe_bruto"))
    return quality.check_ranges(apps, {
        "comision entre 1 % y 8 %": (share, 0.01, 0.08),
        "calificacion 1-5": (F.col("calificacion"), 1, 5),
        "entrega 12-80 min": (F.col("tiempo_entrega_min"), 12, 80),
        "importe >= 0": (F.col("importe_bruto"), 0, None),
    })


# The published quality criteria of the delivery feed, on the cleaned feed itself.
@query("q23_feed_criteria", b.sql("clean_feed", """
    SELECT 'comision entre 18 % y 25 %' AS criterio, count(*) FILTER (WHERE comision_pct NOT BETWEEN 18 AND 25) AS fuera, 0 AS sin_valor FROM clean_feed
    UNION ALL SELECT 'calificacion 1-5', count(*) FILTER (WHERE calificacion NOT BETWEEN 1 AND 5), count(*) FILTER (WHERE calificacion IS NULL) FROM clean_feed
    UNION ALL SELECT 'entrega 12-80 min', count(*) FILTER (WHERE tiempo_entrega_min NOT BETWEEN 12 AND 80), 0 FROM clean_feed"""))
def _(t: Tables):
    return quality.check_ranges(warehouse.clean_feed(b.feed(t), b.platos(t), b.FIRST), {
        "comision entre 18 % y 25 %": (F.col("comision_pct"), 18, 25),
        "calificacion 1-5": (F.col("calificacion"), 1, 5),
        "entrega 12-80 min": (F.col("tiempo_entrega_min"), 12, 80),
    })
