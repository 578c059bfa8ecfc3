import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart import session
from salesmart.operators import quality
from salesmart.sources import feeds, schemas, writers


def test_bom_quotes_and_types(spark, tmp_path):
    (tmp_path / "platos.csv").write_bytes(
        "﻿id_plato,nombre_plato,categoria,precio_base,costo_estimado\n"
        '1,Ceviche Clásico,Ceviches,28,9.21\n2,"Arroz ""rojo"", grande",Arroces,30.50,\n'.encode())
    rows = feeds.read_csv(spark, str(tmp_path), schemas.FEEDS["platos"]).orderBy("id_plato").collect()
    assert [tuple(r) for r in rows] == [
        (1, "Ceviche Clásico", "Ceviches", Decimal("28.00"), Decimal("9.21")),
        (2, 'Arroz "rojo", grande', "Arroces", Decimal("30.50"), None)]


def test_staging_keeps_dirt_as_text(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,fecha\n1,Ayer\n2\n3,05/01/2026,extra\n")
    rows = feeds.read_staging(spark, str(tmp_path), ["id", "fecha"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "Ayer"), ("2", None), ("3", "05/01/2026")]


def test_broken_lines_are_logged_with_their_text(spark, tmp_path):
    (tmp_path / "p.csv").write_text('id,fecha,nota\n1,Ayer,\n2\n\n3,05/01/2026,"a, b"\n4,x,y,extra\nX,y\n', encoding="utf-8")
    staged = feeds.read_staging(spark, str(tmp_path), ["id", "fecha", "nota"], broken="rota")
    whole, broken = feeds.split_broken(staged, "rota")
    assert whole.columns == ["id", "fecha", "nota"]
    assert sorted(map(tuple, whole.collect())) == [("1", "Ayer", None), ("3", "05/01/2026", "a, b")]
    # One column alone still tells whole lines from broken ones.
    assert sorted(r.id for r in whole.select("id").collect()) == ["1", "3"] and whole.count() == 2
    log = quality.broken_rows(broken, "T", "id", "rota")
    rows = {r.texto: r for r in log.collect()}
    assert {k: r.id_registro for k, r in rows.items()} == {"2": 2, "4,x,y,extra": 4, "X,y": None}
    assert all(r.tabla == "T" and r.motivo == quality.BROKEN_LINE and r.valor is None for r in rows.values())
    lines = spark.read.text(str(tmp_path)).filter("value <> 'id,fecha,nota'")
    assert tuple(quality.line_account(lines, staged, "rota").first()) == (6, 2, 3, 1, True)
    rejected = spark.createDataFrame([("P", 9, "m", 1.0)], "tabla string, id_registro bigint, motivo string, valor double")
    assert [r.texto for r in quality.error_log_with_text(rejected, log).filter("tabla = 'P'").collect()] == [None]


DOCS = ['{"_id": 1, "plato": "Ceviche", "puntuacion": 5, "etiquetas": ["fresco"]}',
        '{"_id": 2, "plato": "Arroz", "visita": {"acompanantes": 2, "ocasion": "Cumpleaños"}}']


def test_json_array_and_lines_agree(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "l").mkdir()
    (tmp_path / "a" / "x.json").write_text("[" + ",\n".join(DOCS) + "]")
    (tmp_path / "l" / "x.jsonl").write_text("\n".join(DOCS))
    array = feeds.read_json(spark, str(tmp_path / "a"), schemas.FEEDS["resenas"]).orderBy("_id").collect()
    lines = feeds.read_jsonl(spark, str(tmp_path / "l"), schemas.FEEDS["resenas"]).orderBy("_id").collect()
    assert array == lines
    assert array[0].visita is None and array[1].visita.ocasion == "Cumpleaños" and array[1].etiquetas is None


def test_literal_rows_are_small_for_the_planner(spark):
    dim = feeds.literal_dim(spark, [("Efectivo", "Físico"), ("Yape", None)], schemas.STAR["dim_metodo_pago"])
    assert [tuple(r) for r in dim.orderBy("sk_pago").collect()] == [(1, "Efectivo", "Físico"), (2, "Yape", None)]
    orders = spark.range(1000).selectExpr("concat('Ya', CAST(id AS STRING)) AS metodo_pago", "id")
    plan = orders.join(dim, "metodo_pago")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_export_formats(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, DATE '2026-03-01' AS fecha, TIMESTAMP_NTZ '2026-03-01 09:05:07' AS hora, CAST(2.5 AS DECIMAL(10,2)) AS m")
    writers.export_csv(df, str(tmp_path / "out"))
    row = feeds.read_staging(spark, str(tmp_path / "out"), ["id", "fecha", "hora", "m"]).first()
    assert tuple(row) == ("1", "2026-03-01", "09:05:07", "2.50")


def test_star_csv_reads_empty_as_null(spark, tmp_path):
    (tmp_path / "dim_cliente").mkdir(parents=True)
    header = ",".join(n for n, _ in schemas.fields(schemas.STAR["dim_cliente"]))
    (tmp_path / "dim_cliente" / "x.csv").write_text(f"{header}\n1,9999,C-PASO,,N/A,Cliente de paso,2025-06-01,0,0\n")
    row = feeds.load_star(spark, str(tmp_path), "csv", ["dim_cliente"])["dim_cliente"].first()
    assert row.dni_hash is None and row.fecha_registro == dt.date(2025, 6, 1)


def test_load_master(spark):
    df = spark.createDataFrame([(1, "1234567", "1500.00"), (2, "87654321", " "), (3, "9", "n/a")],
                               "id int, dni_empleado string, salario_mensual string")
    got = [tuple(r)[1:] for r in feeds.load_master(df).orderBy("id").collect()]
    assert got == [("01234567", Decimal("1500.00")), ("87654321", None), ("00000009", None)]


def test_star_csv_is_compressed_and_reads_back(spark, tmp_path):
    rows = [(k, 9000 + k, 'C-"A", b', None, "N/A", "x, y" if k else "", dt.date(2025, 6, 1), k, 1) for k in range(3)]
    dim = spark.createDataFrame(rows, schemas.STAR["dim_cliente"])
    writers.write_star({"dim_cliente": dim}, str(tmp_path), "csv")
    files = [p.name for p in (tmp_path / "dim_cliente").iterdir() if p.name.startswith("part-")]
    assert files and all(name.endswith(".csv.gz") for name in files)
    back = feeds.load_star(spark, str(tmp_path), "csv", ["dim_cliente"])["dim_cliente"].select("sk_cliente", "cliente_seudonimo", "fecha_registro")
    assert sorted(map(tuple, back.collect()))[0] == (0, 'C-"A", b', dt.date(2025, 6, 1))


def test_step_log_as_csv_and_text(spark, tmp_path):
    log = spark.sql("SELECT 'T01' AS paso, 'Quitar \"dobles\"' AS descripcion, 5L AS filas_in, 4L AS filas_out, 1L AS filas_afectadas, "
                    "TIMESTAMP '2026-10-01 15:09:02' AS marca_tiempo")
    writers.write_step_log(log, str(tmp_path))
    text = spark.read.text(str(tmp_path / "text")).first().value
    assert text == '2026-10-01 15:09:02 [T01] Quitar "dobles" | in=5 out=4 afectadas=1'
    back = feeds.read_csv(spark, str(tmp_path / "csv"), "paso string, descripcion string, filas_in bigint")
    assert tuple(back.first()) == ("T01", 'Quitar "dobles"', 5)


def test_tables_are_published_together_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "out")
    assert writers.published(spark, root) == {}
    first = {"A": spark.range(3).selectExpr("id", "CAST(NULL AS string) AS t"), "B": spark.range(2).selectExpr("CAST(id AS decimal(12,2)) AS d")}
    writers.publish(first, root)
    seen = writers.published(spark, root)
    assert list(seen) == ["A", "B"] and [tuple(r) for r in seen["B"].orderBy("d").collect()] == [(Decimal("0.00"),), (Decimal("1.00"),)]
    assert seen["A"].schema == first["A"].schema or [f.dataType for f in seen["A"].schema] == [f.dataType for f in first["A"].schema]

    # The second run fails on its second table: readers go on seeing the first.
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("d"))
    with pytest.raises(Exception, match="lost"):
        writers.publish({"A": spark.range(9).selectExpr("id", "'x' AS t"), "B": broken}, root)
    assert writers.published(spark, root)["A"].count() == 3

    writers.publish({"A": spark.range(7).selectExpr("id", "'x' AS t"), "B": spark.range(1).selectExpr("id AS d")}, root)
    assert writers.published(spark, root)["A"].count() == 7 and writers.published(spark, root)["B"].count() == 1
    assert seen["A"].count() == 3  # a reader keeps its run
    with pytest.raises(ValueError):
        writers.publish({}, root)


def test_step_log_counts_while_the_run_reads(spark):
    source = spark.range(100).selectExpr("id", "id % 7 AS k")
    log = quality.StepLog()
    rows = log.before("T01", "Quitar repetidos", source)
    rows = log.after("T01", "Quitar repetidos", rows.dropDuplicates(["k"]))
    rows = log.step("T02", "Marcar", rows, F.count_if(F.col("k") > 4))
    empty = log.step("T03", "Nada", source.filter("id < 0"), F.sum("k"))
    for df in (rows, empty):
        session.stage(df, "step-log-test")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    found = log.rows(spark)
    assert len(tracker.getJobIdsForGroup()) == before  # no job of its own
    assert "LocalTableScan" in found._jdf.queryExecution().executedPlan().toString() or "ExistingRDD" in found._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r)[:5] for r in found.collect()]
    assert got == [("T01", "Quitar repetidos", 100, 7, 0), ("T02", "Marcar", 7, 7, 2), ("T03", "Nada", 0, 0, 0)]
    with pytest.raises(ValueError):
        log.step("T01", "Otra cosa", source)


def test_audit_log_only_grows(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", "T", None, "1")], "accion string, tabla_afectada string, valor_anterior string, valor_nuevo string")
    writers.append_audit(rows, path)
    writers.append_audit(rows, path)
    assert spark.read.parquet(path).count() == 2


def test_shared_root_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = session.shared_root(spark)
    assert root == configured.rstrip("/") if configured else root


def test_shared_root_is_required_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_root(Session())
