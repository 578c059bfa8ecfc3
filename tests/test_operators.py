import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesmart.operators import access, audit, copies, documents, intake, joins, olap, quality, stats, volume, warehouse, windows
from salesmart.sources import schemas

D = Decimal


def rows(df):
    return [tuple(r) for r in df.collect()]


# joins ------------------------------------------------------------------------

def test_lookup_fails_on_repeated_key(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "nk int, sk string")
    with pytest.raises(PySparkException, match="repeated lookup key"):
        joins.lookup(df, dim, "k", "nk", "sk").collect()


def test_lookup_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (None, "x")], "nk int, sk string")
    assert sorted(rows(joins.lookup(df, dim, "k", "nk", "sk")), key=str) == [(1, "a"), (9, None), (None, None)]


def test_lookup_normalised(spark):
    feed = spark.createDataFrame([("CEBICHE  clasico",), (" cebiche clasico ",), ("otro",)], "plato string")
    dim = spark.createDataFrame([(1, "Ceviche Clásico")], "id_plato int, nombre_plato string")
    got = joins.lookup_normalised(feed, dim, "plato", "nombre_plato", "id_plato").select("plato", "nombre_plato", "id_plato")
    assert set(rows(got)) == {("CEBICHE  clasico", None, None), (" cebiche clasico ", "Ceviche Clásico", 1), ("otro", None, None)}


# windows ----------------------------------------------------------------------

def test_surrogate_key_is_dense_and_ordered(spark):
    values = random.Random(1).sample(range(10**6), 5000)
    df = spark.createDataFrame([(v % 3, v) for v in values], "a int, v int").repartition(7)
    got = windows.surrogate_key(df, ["a", "v"], "sk", start=3).select("sk", "a", "v").collect()
    ordered = sorted((r.a, r.v) for r in got)
    assert [(r.a, r.v) for r in sorted(got)] == ordered
    assert sorted(r.sk for r in got) == list(range(3, 5003))


def test_surrogate_key_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).selectExpr("(id * 7919) % 3001 AS v", "'hot' AS g").repartition(5)
        got = windows.surrogate_key(df, ["g", "v"], "sk")
        assert len(got.inputFiles()) > 1
        values = [r.v for r in sorted(got.collect(), key=lambda r: r.sk)]
        assert values == sorted(values) and len(values) == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_surrogate_key_of_nothing(spark):
    empty = spark.createDataFrame([], "v int")
    assert windows.surrogate_key(empty, ["v"], "sk").count() == 0


def test_dedupe_trims_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o")
    first = windows.dedupe_first(df, ["k"], ["o"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows(first)) == [(0, 0), (1, 1), (2, 2)]
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") < plan.rindex("WindowGroupLimit")


def test_discarded_count_sees_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k int")
    assert rows(windows.discarded_count(df, ["k"])) == [(2,)]


def test_yoy_leaves_gaps_null(spark):
    df = spark.createDataFrame([(2024, 1, D(10)), (2025, 1, D(15)), (2025, 3, D(4))], "anio int, mes_num int, v decimal(10,2)")
    got = {(r.anio, r.mes_num): (r.v_aa, r.crecimiento) for r in windows.yoy(df, ["anio", "mes_num"], "v").collect()}
    assert got == {(2024, 1): (None, None), (2025, 1): (D("10.00"), 0.5), (2025, 3): (None, None)}


def test_yoy_on_leap_day(spark):
    days = [(dt.date(2023, 2, 28), D(2)), (dt.date(2024, 2, 28), D(3)), (dt.date(2024, 2, 29), D(5)), (dt.date(2025, 2, 28), D(7))]
    df = spark.createDataFrame(days, "fecha date, v decimal(10,2)")
    got = {r.fecha: r.v_aa for r in windows.yoy(df, ["fecha"], "v").collect()}
    assert got[dt.date(2024, 2, 29)] == 2 and got[dt.date(2025, 2, 28)] == 3


# percentiles ------------------------------------------------------------------

def _disc(values, p):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


@pytest.mark.parametrize("shape", ["spread", "ties", "outlier", "single"])
def test_exact_percentiles_against_sorting(spark, shape):
    rng = random.Random(7)
    draw = {"spread": lambda: rng.randint(-10**6, 10**6), "ties": lambda: rng.choice([1, 1, 1, 2, 3]),
            "outlier": lambda: rng.choice([0, 1, 2, 3, 10**15]), "single": lambda: 5}[shape]
    data = [(g, draw()) for g in ("a", "b", None) for _ in range(3001)] + [("c", 9), ("d", None)]
    points = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    got = {r.g: r for r in stats.exact_percentiles(spark.createDataFrame(data, "g string, v bigint"), ["g"], "v", points).collect()}
    assert set(got) == {"a", "b", "c", None}
    for g, row in got.items():
        values = [v for k, v in data if k == g]
        assert {n: row[n] for n in points} == {n: _disc(values, p) for n, p in points.items()}


@pytest.mark.parametrize("most", [50, 5_000])
def test_percentiles_of_a_million_values_narrow_first(spark, most):
    df = spark.range(1_000_000).selectExpr("IF(id % 10 = 0, 'b', 'a') AS g", "CAST((id * 7919) % 1000003 AS BIGINT) AS v")
    got = {r.g: (r.p25, r.p50) for r in stats.exact_percentiles(df, ["g"], "v", {"p25": 0.25, "p50": 0.5}, most).collect()}
    for g in "ab":
        values = sorted((i * 7919) % 1000003 for i in range(1_000_000) if (i % 10 == 0) == (g == "b"))
        assert got[g] == (_disc(values, 0.25), _disc(values, 0.5))


def test_percentiles_of_one_heavy_value(spark):
    df = spark.range(20_000).selectExpr("IF(id < 19000, 5, id) AS v")
    assert stats.exact_percentiles(df, [], "v", {"p": 0.5, "q": 0.99}, 100).first().asDict() == {"p": 5, "q": 19799}


def test_joined_ids_leave_nulls_out(spark):
    df = spark.createDataFrame([(None,)] * 150 + [(i,) for i in range(150)], "id int")
    assert stats.joined_ids(df, "id", 9).first()[0] == "0,1,2,3,4"


def test_pivot_totals_count_members_not_shown(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "z", 5.0), ("b", "z", 2.0)], "r string, c string, m double")
    got = {r[0]: tuple(r)[1:] for r in olap.pivot_margins(df, "r", "c", ["x"], "m").collect()}
    assert got == {"a": (1.0, 6.0), "b": (None, 2.0), "Total": (1.0, 8.0)}


@pytest.mark.parametrize("most", [0, 3, 50, 10_000])
def test_exact_quantiles_against_sorting(spark, most):
    """Few, heavily repeated, negative, missing and odd values; small ``most`` makes many rounds."""
    r = random.Random(most)
    nan = float("nan")
    wide = [r.gauss(0, 50) for _ in range(3000)]
    heavy = [5.0] * 2000 + [r.choice([1.0, 2.0, 5.0, 9.0]) for _ in range(500)] + [float(k) for k in range(500)]
    odd = [nan] * 900 + [None] * 900 + [-0.0, float("inf"), -float("inf")] * 400
    two = [1.0] * 1500 + [2.0] * 1500
    columns = {"wide": wide, "heavy": heavy, "odd": odd, "two": two, "none": [None] * 3000, "one": [None] * 2999 + [7.0], "nan": [nan] * 3000}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` double" for c in columns)).repartition(3)
    points = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {row.columna: row for row in stats.exact_quantiles(df, list(columns), points, most).collect()}
    for c, values in columns.items():
        held = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        for name, p in points.items():
            want = held[max(1, math.ceil(len(held) * p)) - 1] if held else None
            assert got[c][name] == want or math.isnan(got[c][name]) and math.isnan(want), (c, name)


def test_summary_does_not_multiply_rows(spark):
    df = spark.range(100_000).selectExpr("id AS a", "id % 10 AS b", "CAST(NULL AS int) AS c")
    got = {r.columna: (r.n, r.p25, r.p50, r.p75) for r in stats.summary_cols(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (100_000, 24_999, 49_999, 74_999), "b": (100_000, 2, 4, 7), "c": (0, None, None, None)}


def test_exact_percentiles_without_groups(spark):
    df = spark.range(101).selectExpr("id AS v")
    assert rows(stats.exact_percentiles(df, [], "v", {"m": 0.5})) == [(50,)]


def test_joined_ids_are_cut_not_lost(spark):
    df = spark.range(1, 5000).selectExpr("id")
    whole = ",".join(str(i) for i in range(1, 5000))
    assert rows(stats.joined_ids(df, "id")) == [(whole[:200],)]


# OLAP -------------------------------------------------------------------------

SALES = [("A", "x", "e", D("10.00")), ("A", "y", "e", D("5.50")), ("B", "x", "i", D("1.25")), (None, "x", "i", D("2.00"))]


def sales(spark):
    return spark.createDataFrame(SALES, "cat string, canal string, origen string, v decimal(12,2)")


def test_cube_tells_null_members_from_totals(spark):
    got = {(r.cat, r.canal, r.g_cat, r.g_canal): r.s for r in olap.cube_sums(sales(spark), ["cat", "canal"], {"s": "v"}).collect()}
    assert got[(None, None, 1, 1)] == D("18.75")
    assert got[(None, None, 0, 1)] == D("2.00")
    assert got[(None, "x", 1, 0)] == D("13.25")
    assert got[(None, "x", 0, 0)] == D("2.00")


def test_pivot_margins(spark):
    got = {r.cat: tuple(r)[1:] for r in olap.pivot_margins(sales(spark), "cat", "canal", ["x", "y"], "v").collect()}
    assert got == {"A": (D("10.00"), D("5.50"), D("15.50")), "B": (D("1.25"), None, D("1.25")), "Total": (D("11.25"), D("5.50"), D("16.75"))}


def test_totals_agree_across_operations(spark):
    df = sales(spark)
    leaf = olap.sum_by(df, ["cat", "canal"], {"s": "v"}).agg(F.sum("s")).first()[0]
    rolled = olap.rollup_sums(df, ["cat", "canal"], {"s": "v"}).filter("g_cat = 1").first().s
    cubed = olap.cube_sums(df, ["cat", "canal"], {"s": "v"}).filter("g_cat = 1 and g_canal = 1").first().s
    sets = olap.grouping_sets(df, ["cat", "canal"], [["cat", "canal"], []], {"s": "v"}).filter("g_cat = 1").first().s
    levels = olap.rollup_levels(df, ["cat", "canal"], {"s": "v"})["cat"].agg(F.sum("s")).first()[0]
    assert leaf == rolled == cubed == sets == levels == D("18.75")


# quality ----------------------------------------------------------------------

LOAD = dt.date(2026, 9, 28)


def staged(spark):
    columns = [n for n, _ in schemas.fields(schemas.STAGING["stg_pedido"])]
    data = [
        ("1", "05/01/2026", "12:30", "7", "1", "Salón", "Yape", "100.00", 1),
        ("1", "05/01/2026", "12:30", "7", "1", "Salón", "Yape", "-5", 2),
        ("2", "Ayer", "13:00", "", "1", "Salón", "Yape", "50.00", 3),
        ("3", "No se sabe", "13:00", "abc", "1", "Salón", "Plin", "-10", 4),
        ("4", "6/1/2026", "13:00", "8", "1", "Salón", "Plin", "n/a", 5),
        ("5", "06/01/2026", "13:00", None, "1", "Salón", "Plin", "0", 6),
    ]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns) + ", fila int")


def staged_lines(spark):
    data = [("10", "1", "1", "2", "50.00", "100.00"), ("11", "3", "1", "1", "10.00", "10.00"), ("12", "9", "1", "1", "4.00", "4.00"),
            ("13", "2", "1", "1", "50.00", "50.00")]
    return spark.createDataFrame(data, schemas.STAGING["stg_detalle"])


def test_bulk_order_load(spark):
    out = quality.load_orders(staged(spark), staged_lines(spark), ["fila"], LOAD)
    assert sorted(rows(out["pedidos"].select("id_pedido", "fecha_pedido", "id_cliente", "monto_total", "fecha_imputada"))) == [
        (1, dt.date(2026, 1, 5), 7, D("100.00"), 0), (2, LOAD, 9999, D("50.00"), 1)]
    assert sorted(r[0] for r in rows(out["detalle"].select("id_detalle"))) == [10, 13]
    assert sorted(rows(out["errores"].select("tabla", "id_registro", "valor")), key=str) == [
        ("Detalle_Pedido", 11, 10.0), ("Detalle_Pedido", 12, 4.0), ("Pedido", 3, -10.0), ("Pedido", 4, None), ("Pedido", 5, 0.0)]
    assert [r[2] for r in rows(out["calidad"])] == [1, 2, 2, 3, 2]


def test_quality_summary_of_nothing_is_zero(spark):
    out = quality.load_orders(staged(spark).filter("id_pedido = '1' and fila = 1"), staged_lines(spark).filter("id_pedido = '1'"), ["fila"], LOAD)
    assert [r[2] for r in rows(out["calidad"])] == [0, 0, 0, 0, 0]


def test_batches_are_refused_whole(spark):
    bad = spark.createDataFrame([(1, D("-10.00")), (2, D("5.00")), (3, D("0.00"))], "id_pedido int, monto_total decimal(12,2)")
    with pytest.raises(quality.ValidationError, match=r"\(2 fila/s\): 1,3"):
        quality.validate_amounts(bad, "fail")
    lines = spark.createDataFrame([(2, D("5.00"), D("10.02"))], "cantidad int, precio_unitario decimal(12,2), subtotal decimal(12,2)")
    with pytest.raises(quality.ValidationError):
        quality.validate_lines(lines, "fail")
    good, aside = quality.validate_amounts(bad)
    assert rows(good) == [(2, D("5.00"))] and aside.count() == 2


def test_amount_report_is_empty_when_all_is_well(spark):
    good = spark.createDataFrame([(1, D("10.00"))], "id_pedido int, monto_total decimal(12,2)")
    assert quality.amount_report(good).count() == 0


def clients(spark):
    data = [("1", "12345678", "05/01/2026", "a@x", "9"), ("1", "12345678", "05/01/2026", "b@x", "9"), ("X", "12345678", "05/01/2026", "", ""),
            ("2", "1234567", "nunca", "", "")]
    df = spark.createDataFrame([(i, d, "N", "A", "D", "Nuevo", f, e, t, n) for n, (i, d, f, e, t) in enumerate(data)],
                               schemas.STAGING["stg_cliente"] + ", fila int")
    return df


def test_bulk_client_load(spark):
    got = quality.load_clients(clients(spark), ["fila"])
    assert sorted(rows(got.select("id_cliente", "dni", "email", "fecha_registro"))) == [
        (1, "12345678", "a@x", dt.date(2026, 1, 5)), (2, None, None, None), (9999, None, None, dt.date(2025, 6, 1))]
    again = quality.load_clients(clients(spark).filter("id_cliente = '2'"), ["fila"], existing=got.filter("id_cliente = 9999"))
    assert sorted(r[0] for r in rows(again.select("id_cliente"))) == [2, 9999]


def test_require_zero(spark):
    dim = spark.createDataFrame([(1,)], "k int")
    df = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    report = quality.check_fk(df, "fk", dim, "k")
    assert rows(report) == [("fk", 2)]
    with pytest.raises(quality.ValidationError):
        quality.require_zero(report, "faltantes", "faltan claves")


def test_reconcile(spark):
    orders = spark.createDataFrame([(1, D("10.00")), (2, D("5.00")), (3, D("1.00"))], "id_pedido int, monto_total decimal(12,2)")
    lines = spark.createDataFrame([(1, D("4.00")), (1, D("6.00")), (2, D("5.01"))], "id_pedido int, subtotal decimal(12,2)")
    assert sorted(r[0] for r in rows(quality.reconcile_totals(orders, lines))) == [2, 3]


def test_compare_copies(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert rows(copies.compare_copies(a, a.repartition(3))) == [(2, 2, 1, 1)]
    assert rows(copies.compare_copies(a, a.filter("k = 1"))) == [(2, 1, 0, 0)]
    empty = a.limit(0)
    assert rows(copies.compare_copies(empty, empty)) == [(0, 0, 1, 1)]
    with pytest.raises(copies.CopiesDiffer, match="columns"):
        copies.compare_copies(a, a.withColumnRenamed("v", "w"))


def test_swapped_values_are_found_and_named(spark):
    a = spark.range(5000).selectExpr("id", "id * 3 AS v", "CASE WHEN id % 9 = 0 THEN id END AS w")
    swapped = a.withColumn("v", F.expr("CASE id WHEN 70 THEN 213 WHEN 71 THEN 210 ELSE v END"))
    assert rows(copies.compare_copies(a, swapped)) == [(5000, 5000, 1, 0)]
    found = sorted(rows(copies.diff_copies(a, swapped)))
    assert found == [(70, 210, None, "a", 1), (70, 213, None, "b", 1), (71, 210, None, "b", 1), (71, 213, None, "a", 1)]
    with pytest.raises(copies.CopiesDiffer, match="ventas.*213"):
        copies.require_same(a, swapped, "ventas")
    copies.require_same(a, a.select("w", "v", "id").repartition(4), "ventas")


def test_a_value_that_moves_to_another_column_and_repeats_are_seen(spark):
    a = spark.createDataFrame([(1, None), (2, 2), (2, 2), (3, 3)], "x int, y int")
    b = spark.createDataFrame([(None, 1), (2, 2), (3, 3), (3, 3)], "x int, y int")
    want = {(1, None, "a", 1), (None, 1, "b", 1), (2, 2, "a", 1), (3, 3, "b", 1)}
    assert set(rows(copies.diff_copies(a, b))) == want
    assert rows(copies.diff_copies(a, a.union(a.limit(0)))) == []


# intake -----------------------------------------------------------------------

def menu(spark):
    return spark.createDataFrame([(4, D("12.50")), (6, D("7.25"))], "id_plato int, precio_base decimal(12,2)")


def test_intake_of_mixed_and_bad_orders(spark):
    orders = spark.createDataFrame([(51, 8), (52, None), (53, 9)], "id_pedido int, id_cliente int")
    lines = spark.createDataFrame(
        [(1, 51, 77, 3), (2, 52, 6, 4), (3, 52, 4, -2), (4, 52, 4, 1), (5, 53, 4, None), (6, 52, 78, 1)],
        "id_detalle int, id_pedido int, id_plato int, cantidad int")
    accepted, kept, errors = intake.intake_orders(orders, lines, menu(spark))
    assert rows(accepted.select("id_pedido", "id_cliente", "monto_total")) == [(52, 9999, D("41.50"))]
    assert sorted(rows(kept.select("id_detalle", "subtotal"))) == [(2, D("29.00")), (4, D("12.50"))]
    assert sorted(rows(errors)) == [
        ("Detalle_Pedido", 3, intake.BAD_QUANTITY), ("Detalle_Pedido", 6, intake.UNKNOWN_DISH),
        ("Pedido", 51, intake.NO_VALID_LINES), ("Pedido", 53, intake.NO_VALID_LINES)]


# audit ------------------------------------------------------------------------

EMP = "id_empleado int, cargo string, salario_mensual decimal(10,2)"


def test_salary_update_and_audit(spark):
    staff = spark.createDataFrame([(16, "Mozo", D("1500.00")), (17, "Cajero", None)], EMP)
    updates = spark.createDataFrame([(16, D("1800.00")), (17, D("500.00")), (9999, D("1800.00"))], "id_empleado int, nuevo_salario decimal(10,2)")
    after, errors = audit.update_salary(staff, updates)
    assert sorted(rows(after)) == [(16, "Mozo", D("1800.00")), (17, "Cajero", None)]
    assert sorted(rows(errors.select("id_registro", "numero_error"))) == [(17, 51011), (9999, 51010)]
    assert rows(audit.audit_salary(staff, after)) == [("Cambio de salario del empleado ID 16", "Empleado", "1500.00", "1800.00")]


def test_salary_audit_reads_null_as_minus_one(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", D("-1.00")), (3, "c", None)], EMP)
    after = spark.createDataFrame([(1, "a", D("5.00")), (2, "b", None), (3, "c", None)], EMP)
    assert [r[0] for r in rows(audit.audit_salary(before, after))] == ["Cambio de salario del empleado ID 1"]


def test_order_amount_audit_skips_placeholder(spark):
    schema = "id_pedido int, monto_total decimal(12,2)"
    before = spark.createDataFrame([(1, D("0.01")), (2, D("5.00")), (3, D("5.00"))], schema)
    after = spark.createDataFrame([(1, D("9.00")), (2, D("6.00"))], schema)
    assert [r[0] for r in rows(audit.audit_amount(before, after))] == ["Modificación de monto del pedido 2"]
    assert rows(audit.audit_cancelled(before, after)) == [("Anulación (DELETE) del pedido 3", "Pedido", "5.00", None)]


# documents --------------------------------------------------------------------

def catalog(spark):
    schema = schemas.FEEDS["menu"]
    return spark.createDataFrame([
        ("Tallarín", D("18.50"), None, ["gluten"], [("p1", 3, "Bien.")], None, None),
        ("Sopa", D("9.00"), ["Pan"], None, None, None, True),
        ("Flan", D("6.75"), ["Pan", "Miel"], ["huevo", "leche"], None, "todo el año", None)], schema)


def test_menu_crud(spark):
    docs = catalog(spark)
    assert sorted(rows(documents.find_contains(docs, "ingredientes_extra", "Pan").select("plato_principal"))) == [("Flan",), ("Sopa",)]
    assert rows(documents.find_any(docs, "alergenos", ["leche", "soya"], ["plato_principal", "precio_base"])) == [("Flan", D("6.75"))]
    changed = documents.update_one(
        docs, F.col("precio_base") < 10, "plato_principal", ["plato_principal"],
        {"precio_base": F.lit("8.00").cast("decimal(10,2)")}, {"ingredientes_extra": "Sal"})
    after = {r.plato_principal: (r.precio_base, r.ingredientes_extra) for r in changed.collect()}
    assert after == {"Flan": (D("8.00"), ["Pan", "Miel", "Sal"]), "Sopa": (D("9.00"), ["Pan"]), "Tallarín": (D("18.50"), None)}
    left = documents.delete_where(changed, F.col("precio_base") > 10, "plato_principal", ["plato_principal"])
    assert left.count() == 2 and changed.count() == 3


def test_insert_with_other_fields(spark):
    more = spark.createDataFrame([("Jalea", True)], "plato_principal string, para_compartir boolean")
    docs = documents.insert_docs(catalog(spark), more)
    assert docs.count() == 4 and docs.filter("para_compartir is null").count() == 3


def test_scalar_contains(spark):
    df = spark.createDataFrame([("a",), ("b",)], "tag string")
    assert documents.find_contains(df, "tag", "a").count() == 1


def test_delete_keeps_rows_where_predicate_is_null(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "_id int, p int")
    assert sorted(r[0] for r in rows(documents.delete_where(df, F.col("p") > 2))) == [1, 3]


# access -----------------------------------------------------------------------

def test_allowed_columns(spark):
    people = spark.createDataFrame([(1, "12345678", "a@x")], "id_cliente int, dni string, email string")
    assert access.allowed_columns(people, {"email", "id_cliente", "other"}).columns == ["id_cliente", "email"]


def test_row_filter(spark):
    orders = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "id_pedido int, id_cliente int")
    users = spark.createDataFrame([(1, "u_cliente1"), (2, None)], "id_cliente int, usuario_bd string")
    assert sorted(r[0] for r in rows(access.row_filter(orders, users, "u_cliente1", {access.CUSTOMER}).select("id_pedido"))) == [1, 3]
    assert access.row_filter(orders, users, "u_otro", {access.CUSTOMER}).count() == 0
    assert access.row_filter(orders, users, "u_otro", {access.SELLER}).count() == 3
    assert access.row_filter(orders, users, "u_otro", {access.CUSTOMER, access.OWNER}).count() == 3


# warehouse --------------------------------------------------------------------

def test_dim_customer_members_come_first(spark):
    people = spark.createDataFrame(
        [(5, "12345678", "D", "Nuevo", dt.date(2026, 7, 14)), (9999, None, "N/A", "Nuevo", dt.date(2025, 6, 1)), (2, None, "D", "Nuevo", dt.date(2026, 1, 1))],
        "id_cliente bigint, dni string, distrito string, tipo_cliente string, fecha_registro date")
    dim = warehouse.build_dim_customer(people, LOAD, "s").orderBy("sk_cliente")
    assert rows(dim.select("sk_cliente", "id_cliente_nk", "cliente_seudonimo", "antiguedad_meses", "es_cliente_identificado")) == [
        (1, 9999, "C-PASO", 0, 0), (2, 9998, "C-APP", 0, 0), (3, 2, "C-00002", round(270 / 30.4), 1), (4, 5, "C-00005", 2, 1)]
    assert dim.filter("dni_hash is null").count() == 3


def test_dim_dish(spark):
    dishes = spark.createDataFrame([(1, "Ceviche Clásico", "Ceviches", D("28.00"), D("9.21"))],
                                   "id_plato int, nombre_plato string, categoria string, precio_base decimal(12,2), costo_estimado decimal(12,2)")
    assert rows(warehouse.build_dim_dish(dishes)) == [(1, 1, "Ceviche Clásico", "Ceviches", D("28.00"), D("9.21"), D("18.79"), D("67.1"), "Medio (16-30)")]


def test_dim_date_flags_holidays(spark):
    holidays = spark.createDataFrame([(dt.date(2026, 1, 1), "Año Nuevo")], schemas.FEEDS["feriados"])
    dim = warehouse.build_dim_date(spark, dt.date(2025, 12, 31), dt.date(2026, 1, 2), holidays).orderBy("fecha")
    assert rows(dim.select("sk_fecha", "es_feriado", "nombre_feriado")) == [(20251231, 0, ""), (20260101, 1, "Año Nuevo"), (20260102, 0, "")]


# volume -----------------------------------------------------------------------

def test_timings_median(spark):
    data = [("x1", 10, r, us) for r, us in enumerate((300_000, 100_000, 200_400), 1)]
    df = spark.createDataFrame(data, "tabla string, filas int, corrida int, microseg bigint")
    assert rows(volume.timings_median(df)) == [("x1", 10, 0.2)]


# star -------------------------------------------------------------------------

def test_fact_branches_are_numbered_apart_and_sorted_narrow(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "SORT_ROWS", 10)
    keys = "1L AS sk_cliente, id AS sk_plato, 1L AS sk_empleado, 1 AS sk_pago, 1 AS sk_canal, 1 AS sk_turno, 2 AS cantidad".split(", ")
    sums = "500L AS precio_unitario, 1000L AS importe_bruto, 300L AS costo_total".split(", ")
    own = spark.range(100).selectExpr("20240101 AS sk_fecha", *keys, *sums, "id * 37 % 50 AS _orden1", "id AS _orden2")
    apps = spark.range(3).selectExpr("20240102 AS sk_fecha", *keys, *sums, "'EXT-' || (3 - id) AS nro_pedido", "'CSV externo' AS origen",
                                     "100L AS comision_plataforma", "900L AS importe_neto", "7 AS tiempo_entrega_min", "CAST(4 AS DECIMAL(2,1)) AS calificacion")
    fact = warehouse.build_fact(own.withColumns(warehouse._internal_columns()), apps, lines=100)
    got = rows(fact.orderBy("sk_venta").select("sk_venta", "nro_pedido", "sk_plato", "comision_plataforma", "importe_neto", "margen_bruto"))
    inner = sorted((n * 37 % 50, n) for n in range(100))
    assert got == [(k, f"SQL-{o}", n, D("0.00"), D("10.00"), D("7.00")) for k, (o, n) in enumerate(inner, 1)] + [
        (100 + k, f"EXT-{k}", 3 - k, D("1.00"), D("9.00"), D("6.00")) for k in (1, 2, 3)]
    # The first branch is staged by tasks of about SORT_ROWS rows, without the columns that follow from others.
    staged = {f.rsplit("/", 1)[0] for f in fact.inputFiles()}
    columns = [set(spark.read.parquet(folder).columns) for folder in staged]
    assert any("_orden1" in c and not c & {"nro_pedido", "origen", "importe_neto", "margen_bruto"} for c in columns)
    assert len(fact.inputFiles()) > 8


def test_star_view_joins_growing_dimensions_on_narrow_rows(spark):
    dims = {"dim_fecha": "sk_fecha, 2024 AS anio", "dim_plato": "sk_plato, 'p' AS nombre_plato", "dim_canal": "sk_canal, 'c' AS canal",
            "dim_turno": "sk_turno, 't' AS turno", "dim_metodo_pago": "sk_pago, 'm' AS metodo_pago", "dim_empleado": "sk_empleado, 'e' AS cargo",
            "dim_cliente": "sk_cliente, 7L AS id_cliente_nk, 'd' AS distrito, 'f' AS tipo_cliente, 1 AS es_cliente_identificado"}
    tables = {name: spark.range(1).selectExpr(*f"1 AS {text}".split(", ")) for name, text in dims.items()}
    tables["fact_ventas"] = spark.range(1).selectExpr("5L AS sk_venta", *[f"1 AS {key}" for key in warehouse.FACT_KEYS])
    view = warehouse.star_view(tables)
    assert view.columns == ["sk_cliente", "sk_empleado", "sk_pago", "sk_turno", "sk_canal", "sk_plato", "sk_fecha", "sk_venta", "anio", "nombre_plato",
                            "canal", "turno", "metodo_pago", "cargo", "id_cliente_nk", "distrito", "tipo_cliente", "es_cliente_identificado"]
    assert rows(view) == [(1,) * 7 + (5, 2024, "p", "c", "t", "m", "e", 7, "d", "f", 1)]
    plan = view._jdf.queryExecution().analyzed().toString()
    joins_of = [line.split("sk_")[1].split("#")[0] for line in plan.splitlines() if "Join Inner" in line]
    assert joins_of[-2:] == ["plato", "cliente"]  # the innermost joins come last in the text
