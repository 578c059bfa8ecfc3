"""Sources and sinks: S1-S18.  Files are written from the shared tables, then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import copies, quality, stats, warehouse
from ..session import stage, staging_dir
from ..sources import feeds, schemas, writers
from ..sources.tables import Tables
from . import bindings as b
from .quality import ERRORS, SUMMARY
from .registry import query

FACT_LIKE = {
    "sk_venta": "l_orderkey * 10 + l_linenumber", "sk_fecha": "CAST({ymd} AS INT)", "sk_cliente": "l_suppkey",
    "sk_plato": "l_partkey", "sk_empleado": "l_suppkey", "sk_pago": "l_linenumber", "sk_canal": "l_linenumber",
    "sk_turno": "1", "nro_pedido": "'SQL-' || CAST(l_orderkey AS STRING)", "origen": "l_linestatus",
    "cantidad": "CAST(l_quantity AS INT)", "precio_unitario": "l_tax", "importe_bruto": "l_extendedprice",
    "comision_plataforma": "l_discount", "importe_neto": "l_extendedprice", "costo_total": "l_tax",
    "tiempo_entrega_min": "CASE WHEN l_linestatus = 'O' THEN CAST(l_linenumber AS INT) END",
    "calificacion": "CASE WHEN l_linestatus = 'O' THEN CAST(l_linenumber AS DOUBLE) END", "margen_bruto": "l_extendedprice",
}


def _fact_like(ymd: str) -> list[str]:
    return [f"{e.format(ymd=ymd)} AS {n}" for n, e in FACT_LIKE.items()]


def _csv(df: DataFrame, label: str) -> str:
    path = staging_dir(df.sparkSession, label)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("s01_csv_fact_scan", "SELECT " + ", ".join(_fact_like("strftime(l_shipdate, '%Y%m%d')")) + " FROM lineitem")
def _(t: Tables):
    path = _csv(t.lineitem.selectExpr(*_fact_like("date_format(l_shipdate, 'yyyyMMdd')")), "fact_csv")
    return feeds.read_csv(t.spark, path, schemas.FACT_CSV)


@query("s02_csv_typed_scan", """
    SELECT CAST(o_orderkey AS INT) AS id_pedido, strftime(o_orderdate, '%d/%m/%Y') AS fecha_pedido, '12:30' AS hora_pedido,
      CAST(o_custkey AS INT) AS id_cliente, 1 AS id_empleado, o_orderpriority AS canal_interno, o_orderstatus AS metodo_pago,
      o_totalprice AS monto_total FROM orders""")
def _(t: Tables):
    raw = t.orders.selectExpr(
        "o_orderkey AS id_pedido", "date_format(o_orderdate, 'dd/MM/yyyy') AS fecha_pedido", "'12:30' AS hora_pedido",
        "o_custkey AS id_cliente", "1 AS id_empleado", "o_orderpriority AS canal_interno", "o_orderstatus AS metodo_pago",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS monto_total")
    return feeds.read_csv(t.spark, _csv(raw, "pedidos_csv"), schemas.FEEDS["pedidos"])


@query("s03_csv_bom_scan", """
    SELECT CAST(p_partkey AS INT) AS id_plato, 'el "' || p_name || '", fresco' AS nombre_plato, p_type AS categoria,
      p_retailprice AS precio_base, 0.5::DOUBLE AS costo_estimado FROM part""")
def _(t: Tables):
    raw = t.part.selectExpr(
        "p_partkey AS id_plato", "concat('el \"', p_name, '\", fresco') AS nombre_plato", "p_type AS categoria",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS precio_base", "CAST(0.5 AS DECIMAL(10,2)) AS costo_estimado")
    marked = raw.withColumnRenamed("id_plato", "﻿id_plato")
    return feeds.read_csv(t.spark, _csv(marked, "platos_bom"), schemas.FEEDS["platos"])


@query("s04_staging_scan", b.sql("stg_pedido", """
    SELECT id_pedido, fecha_pedido, hora_pedido, nullif(id_cliente, '') AS id_cliente, id_empleado, canal_interno,
      metodo_pago, monto_total FROM stg_pedido"""))
def _(t: Tables):
    columns = [name for name, _ in schemas.fields(schemas.STAGING["stg_pedido"])]
    staged = feeds.read_staging(t.spark, _csv(b.stg_pedido(t).select(*columns), "stg_pedido"), columns)
    return staged.withColumn("id_cliente", F.nullif("id_cliente", F.lit("")))


# Of every fifty staged lines one lacks its last field and one has a field too many.
SHORT, LONG, BROKEN = 7, 31, "_linea_rota"
DETAIL = [name for name, _ in schemas.fields(schemas.STAGING["stg_detalle"])]
BROKEN_SQL = f"""
    SELECT 'Detalle_Pedido' AS tabla, CAST(id_detalle AS BIGINT) AS id_registro, '{quality.BROKEN_LINE}' AS motivo, CAST(NULL AS DOUBLE) AS valor,
      concat_ws(',', {", ".join(DETAIL[:-1])}) || CASE CAST(id_detalle AS BIGINT) % 50 WHEN {LONG} THEN ',' || subtotal || ',de más' ELSE '' END AS texto
    FROM stg_detalle WHERE CAST(id_detalle AS BIGINT) % 50 IN ({SHORT}, {LONG})"""


def _ragged_file(t: Tables) -> str:
    """The staged order lines as a text file without a header, some of them broken."""
    nth = F.col("id_detalle").cast("bigint") % 50
    fields = [F.coalesce(F.col(c), F.lit("")) for c in DETAIL]
    line = F.when(nth == SHORT, F.concat_ws(",", *fields[:-1])).when(nth == LONG, F.concat_ws(",", *fields, F.lit("de más")))
    path = staging_dir(t.spark, "stg_detalle_ragged")
    b.stg_detalle(t).select(line.otherwise(F.concat_ws(",", *fields)).alias("value")).write.text(path)
    return path


def _ragged(t: Tables, path: str) -> DataFrame:
    return feeds.read_staging(t.spark, path, DETAIL, header=False, broken=BROKEN)


@query("s04_broken_rows", b.sql("stg_detalle", BROKEN_SQL))
def _(t: Tables):
    broken = feeds.split_broken(_ragged(t, _ragged_file(t)), BROKEN)[1]
    return quality.broken_rows(broken, "Detalle_Pedido", "id_detalle", BROKEN)


@query("s04_line_account", b.sql("stg_detalle", f"""
    SELECT count(*) AS leidas, count(*) FILTER (WHERE CAST(id_detalle AS BIGINT) % 50 NOT IN ({SHORT}, {LONG})) AS enteras,
      count(*) FILTER (WHERE CAST(id_detalle AS BIGINT) % 50 IN ({SHORT}, {LONG})) AS rotas, CAST(0 AS BIGINT) AS vacias, TRUE AS cuadra FROM stg_detalle"""))
def _(t: Tables):
    path = _ragged_file(t)
    return quality.line_account(t.spark.read.text(path), _ragged(t, path), BROKEN)


@query("q10_error_log_with_text", b.sql("stg_pedido stg_detalle", f"""
    WITH {ERRORS} SELECT *, CAST(NULL AS VARCHAR) AS texto FROM err WHERE tabla <> 'Detalle_Pedido' OR id_registro % 50 NOT IN ({SHORT}, {LONG})
    UNION ALL {BROKEN_SQL}"""))
def _(t: Tables):
    whole, broken = feeds.split_broken(_ragged(t, _ragged_file(t)), BROKEN)
    log = quality.load_orders(b.stg_pedido(t), whole, b.FIRST, b.LOAD_DATE)["errores"]
    return quality.error_log_with_text(log, quality.broken_rows(broken, "Detalle_Pedido", "id_detalle", BROKEN))


@query("s05_load_master", """
    SELECT s_suppkey AS id_empleado, right('00000000' || (s_suppkey * 7919), 8) AS dni_empleado,
      CASE WHEN s_suppkey % 9 = 4 THEN NULL ELSE s_acctbal END AS salario_mensual FROM supplier""")
def _(t: Tables):
    raw = t.supplier.selectExpr(
        "s_suppkey AS id_empleado", "CAST(s_suppkey * 7919 AS STRING) AS dni_empleado",
        "CASE WHEN s_suppkey % 9 = 4 THEN ' ' ELSE CAST(CAST(s_acctbal AS DECIMAL(10,2)) AS STRING) END AS salario_mensual")
    return feeds.load_master(raw)


ATTENDANCE = {"id_asistencia": "CAST(l_orderkey * 10 + l_linenumber AS INT)", "id_empleado": "CAST(l_suppkey AS INT)",
              "fecha": "CAST(l_shipdate AS DATE)", "hora_ingreso": "'10:0' || CAST(l_linenumber AS STRING)",
              "horas_trabajadas": "CAST(l_quantity * 0.25 AS DECIMAL(5,2))", "tardanza_min": "CAST(l_linenumber AS INT)"}


@query("s06_attendance_scan", "SELECT " + ", ".join(
    f"{e} AS {n}" if n != "horas_trabajadas" else f"CAST({e} AS DOUBLE) AS {n}" for n, e in ATTENDANCE.items()) + " FROM lineitem")
def _(t: Tables):
    raw = t.lineitem.selectExpr(*[f"{e} AS {n}" for n, e in ATTENDANCE.items()])
    return feeds.read_csv(t.spark, _csv(raw, "asistencia"), schemas.FEEDS["asistencia"])


def json_array_files(df: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Each file holds one JSON array: an opening bracket, one document per line, a closing bracket.

    The number of files follows the number of documents: a file can only be parsed as a whole.
    """
    files = max(1, -(-df.count() // per_file))
    bucket = F.pmod(F.xxhash64(*df.columns), F.lit(files)).cast("int")
    docs = df.select(bucket.alias("b"), F.lit(1).alias("o"), F.to_json(F.struct(*df.columns)).alias("j"))
    ends = df.sparkSession.range(files).select(F.col("id").cast("int").alias("b"), F.explode(F.array(F.lit(0), F.lit(2))).alias("o"), F.lit(None).cast("string").alias("j"))
    laid = docs.unionByName(ends).repartition(files, "b").sortWithinPartitions("b", "o")
    # The bracket line carries an empty document, so every following document can start with a comma.
    line = F.when(F.col("o") == 0, "[{}").when(F.col("o") == 2, "]").otherwise(F.concat(F.lit(","), F.col("j")))
    laid.select("b", line.alias("value")).write.partitionBy("b").text(path)


REVIEW_DOC = ("_id bigint, plato string, puntuacion int, etiquetas array<string>, respuesta_local string, "
              "visita struct<acompanantes:int, ocasion:string>")
REVIEW_FLAT = """SELECT _id, plato, puntuacion, array_to_string(etiquetas, ' ') AS etiquetas, respuesta_local,
      acompanantes, ocasion FROM resenas"""


def _flat(df: DataFrame) -> DataFrame:
    return df.select("_id", "plato", "puntuacion", F.array_join("etiquetas", " ").alias("etiquetas"), "respuesta_local",
                     "visita.acompanantes", "visita.ocasion")


@query("s07_json_array_scan", b.sql("resenas", REVIEW_FLAT))
def _(t: Tables):
    docs = b.resenas(t).select("_id", "plato", "puntuacion", "etiquetas", "respuesta_local", "visita")
    path = staging_dir(t.spark, "resenas_array")
    json_array_files(docs, path)
    return _flat(feeds.read_json(t.spark, path, REVIEW_DOC).filter("_id is not null"))


@query("s08_json_lines_scan", b.sql("resenas", REVIEW_FLAT))
def _(t: Tables):
    path = staging_dir(t.spark, "resenas_lines")
    b.resenas(t).select("_id", "plato", "puntuacion", "etiquetas", "respuesta_local", "visita").write.json(path)
    return _flat(feeds.read_jsonl(t.spark, path, REVIEW_DOC))


@query("s09_reference_table", b.sql("holidays", "SELECT fecha, feriado, count(o_orderkey) AS pedidos FROM holidays LEFT JOIN orders ON CAST(o_orderdate AS DATE) = fecha GROUP BY 1, 2"))
def _(t: Tables):
    days = feeds.read_csv(t.spark, _csv(b.holidays(t), "feriados"), schemas.FEEDS["feriados"])
    per_day = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("fecha")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "fecha", "left").select("fecha", "feriado", F.coalesce("n", F.lit(0)).alias("pedidos"))


@query("s10_literal_dims", b.sql("pedidos dim_metodo_pago", "SELECT tipo_pago, count(id_pedido) AS pedidos FROM dim_metodo_pago LEFT JOIN pedidos USING (metodo_pago) GROUP BY 1"))
def _(t: Tables):
    dim = feeds.literal_dim(t.spark, warehouse.PAYMENTS, schemas.STAR["dim_metodo_pago"])
    per_payment = b.pedidos(t).groupBy("metodo_pago").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(per_payment, "metodo_pago", "left").groupBy("tipo_pago").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pedidos"))


STAR_NAMES = list(schemas.STAR)


STAR_COLUMNS = {name: [c for c, _ in schemas.fields(schemas.STAR[name])] for name in STAR_NAMES}


def _rows_sql(text: str) -> str:
    """Every row of every star table, its columns as one text."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, concat_ws('|', {', '.join(f'coalesce({text.format(c)}, chr(0))' for c in columns)}) AS fila FROM {name}"
        for name, columns in STAR_COLUMNS.items())


def _read_back(star, loaded) -> DataFrame:
    """The rows of the loaded tables, once each is known to be a copy of what was written."""
    parts = []
    for name, columns in STAR_COLUMNS.items():
        copies.require_same(star[name].select(*columns), loaded[name].select(*columns), name)
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
        parts.append(loaded[name].select(F.lit(name).alias("tabla"), F.concat_ws("|", *cells).alias("fila")))
    return reduce(DataFrame.unionByName, parts)


@query("s11_load_star", b.sql(" ".join(STAR_NAMES), _rows_sql("CAST({0} AS STRING)")))
def _(t: Tables):
    path = staging_dir(t.spark, "star")
    writers.write_star(b.star(t), path)
    return _read_back(b.star(t), feeds.load_star(t.spark, path))


@query("s12_write_star_csv", b.sql(" ".join(STAR_NAMES), _rows_sql("nullif(CAST({0} AS STRING), '')")))
def _(t: Tables):
    path = staging_dir(t.spark, "star_csv")
    writers.write_star(b.star(t), path, "csv")
    # CSV has one form for an empty text and a missing one; it is read as missing.
    blank = lambda df: df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes])
    return _read_back({name: blank(b.star(t)[name]) for name in STAR_NAMES}, feeds.load_star(t.spark, path, "csv"))


MONTH_SQL = """SELECT d.anio_mes, c.canal, sum(f.importe_neto)::DOUBLE AS ventas
    FROM fact_ventas f JOIN dim_fecha d ON d.sk_fecha = f.sk_fecha JOIN dim_canal c ON c.sk_canal = f.sk_canal
    GROUP BY d.anio_mes, c.canal"""


@query("s13_register_star", b.sql("fact_ventas dim_fecha dim_canal", MONTH_SQL))
def _(t: Tables):
    feeds.register_star(b.star(t))
    return t.spark.sql(MONTH_SQL.replace("::DOUBLE", ""))


@query("s14_export_csv", """
    SELECT CAST(o_orderkey AS STRING) AS id_pedido, strftime(o_orderdate, '%Y-%m-%d') AS fecha_pedido,
      '10:30:00' AS hora_pedido, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS STRING) AS monto_total FROM orders""")
def _(t: Tables):
    path = staging_dir(t.spark, "export")
    writers.export_csv(t.orders.select(
        F.col("o_orderkey").alias("id_pedido"), F.col("o_orderdate").cast("date").alias("fecha_pedido"),
        (F.col("o_orderdate") + F.expr("interval '10:30' hour to minute")).alias("hora_pedido"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("monto_total")), path)
    return feeds.read_staging(t.spark, path, ["id_pedido", "fecha_pedido", "hora_pedido", "monto_total"])


# The eight outputs of a load and the columns they are compared by.
CLEAN = {
    "Cliente": "id_cliente dni nombre apellido email telefono distrito tipo_cliente fecha_registro",
    "Empleado": "id_empleado dni_empleado apellido",
    "Plato": "id_plato nombre_plato categoria precio_base costo_estimado",
    "Pedido": "id_pedido fecha_pedido id_cliente id_empleado canal_interno metodo_pago monto_total fecha_imputada",
    "Detalle_Pedido": "id_detalle id_pedido id_plato cantidad precio_unitario subtotal",
    "Asistencia": " ".join(ATTENDANCE),
    "Log_Errores": "tabla id_registro motivo valor",
    "Log_Carga_Calidad": "tabla regla registros_afectados",
}
_CLEAN_FROM = {
    "Cliente": """(SELECT * REPLACE (CASE WHEN regexp_full_match(dni, '[0-9]{8}') THEN dni END AS dni)
      FROM (SELECT *, row_number() OVER (PARTITION BY id_cliente ORDER BY copia) AS rn FROM stg_cliente) WHERE rn = 1)""",
    "Empleado": "empleados", "Plato": "platos", "Pedido": "ok", "Detalle_Pedido": "(SELECT * FROM lin WHERE id_pedido IN (SELECT id_pedido FROM ok))",
    "Asistencia": "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in ATTENDANCE.items()) + " FROM lineitem)",
    "Log_Errores": "(SELECT * REPLACE (CAST(valor AS DECIMAL(12,2)) AS valor) FROM err)", "Log_Carga_Calidad": f"({SUMMARY})",
}


def clean_tables(t: Tables) -> dict[str, DataFrame]:
    """What a load leaves: cleaned clients, orders and lines, the master tables, the error and the quality log."""
    clients = quality.null_invalid_id(quality.windows.dedupe_first(b.stg_cliente(t), ["id_cliente"], b.FIRST), "dni")
    loaded = quality.load_orders(b.stg_pedido(t), b.stg_detalle(t), b.FIRST, b.LOAD_DATE)
    tables = {
        "Cliente": clients, "Empleado": b.empleados(t), "Plato": b.platos(t), "Pedido": loaded["pedidos"], "Detalle_Pedido": loaded["detalle"],
        "Asistencia": t.lineitem.selectExpr(*[f"{e} AS {n}" for n, e in ATTENDANCE.items()]),
        "Log_Errores": loaded["errores"].withColumn("valor", F.col("valor").cast("decimal(12,2)")), "Log_Carga_Calidad": loaded["calidad"]}
    return {name: tables[name].select(*columns.split()) for name, columns in CLEAN.items()}


def _clean_sql(name: str, columns: str) -> str:
    cells = ", ".join(f"coalesce(nullif(CAST({c} AS STRING), ''), chr(0))" for c in columns.split())
    return f"SELECT '{name}' AS tabla, concat_ws('|', {cells}) AS fila FROM {_CLEAN_FROM[name]}"


@query("s15_write_clean", b.sql("stg_cliente empleados platos stg_pedido stg_detalle", f"WITH {ERRORS} " + " UNION ALL ".join(
    _clean_sql(name, columns) for name, columns in CLEAN.items())))
def _(t: Tables):
    path = staging_dir(t.spark, "clean")
    writers.publish(clean_tables(t), path)
    cells = lambda df: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in df.columns])
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("tabla"), cells(df).alias("fila")) for name, df in writers.published(t.spark, path).items()])


@query("s16_step_log_sink", b.sql("feed clean_feed platos", """
    SELECT 'E02' AS paso, 0 AS filas_in, count(*) AS filas_out, 0 AS filas_afectadas FROM feed
    UNION ALL SELECT 'T01', (SELECT count(*) FROM feed), count(DISTINCT order_ref), count(*) - count(DISTINCT order_ref) FROM feed
    UNION ALL SELECT 'L03', count(*), count(*), 0 FROM platos"""))
def _(t: Tables):
    raw, dishes = b.feed(t), b.platos(t)
    log = quality.StepLog()
    raw = log.after("E02", "Extracción de la fuente externa", raw)
    raw = log.before("T01", "Eliminar duplicados por order_ref", raw)
    first = log.after("T01", "Eliminar duplicados por order_ref", quality.windows.dedupe_first(raw, ["order_ref"], b.FIRST))
    dishes = log.step("L03", "Construir dimensión de platos", dishes)
    stage(first, "feed")
    warehouse.build_dim_dish(stage(dishes, "platos"))
    dropped = F.when(F.col("paso") == "T01", F.col("filas_in") - F.col("filas_out")).otherwise(F.col("filas_afectadas"))
    path = staging_dir(t.spark, "etl_log")
    writers.write_step_log(log.rows(t.spark).withColumn("filas_afectadas", dropped), path)
    schema = "paso string, descripcion string, filas_in bigint, filas_out bigint, filas_afectadas bigint, marca_tiempo timestamp"
    return feeds.read_csv(t.spark, f"{path}/csv", schema).select("paso", "filas_in", "filas_out", "filas_afectadas")


VIEW_SQL = """SELECT p_type AS categoria, count(*) AS lineas, CAST(sum(l_quantity) AS BIGINT) AS unidades
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type"""


@query("s17_sql_text", VIEW_SQL)
def _(t: Tables):
    t.register()
    return t.spark.sql(VIEW_SQL)


@query("s18_export_orders", b.sql("pedidos", """
    SELECT id_pedido, fecha_pedido, hora_pedido, id_cliente, id_empleado, canal_interno, metodo_pago, monto_total::DOUBLE AS monto_total, fecha_imputada FROM pedidos"""))
def _(t: Tables):
    return warehouse.export_orders(b.pedidos(t))


@query("s18_export_lines", b.sql("detalle", """
    SELECT id_detalle, id_pedido, id_plato, cantidad, precio_unitario::DOUBLE AS precio_unitario, subtotal::DOUBLE AS subtotal FROM detalle"""))
def _(t: Tables):
    return warehouse.export_lines(b.detalle(t))


@query("s18_export_dishes", b.sql("platos", """
    SELECT id_plato, nombre_plato, categoria, precio_base::DOUBLE AS precio_base, costo_estimado::DOUBLE AS costo_estimado FROM platos"""))
def _(t: Tables):
    return warehouse.export_dishes(b.platos(t))
