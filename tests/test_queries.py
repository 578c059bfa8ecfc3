"""Every registered query against its SQL twin, and its plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmart import session
from salesmart.functions import text
from salesmart.operators import quality, warehouse
from salesmart.plans import bindings, oracle_sql, queries
from salesmart.sources.tables import Tables
from tests.compare import connect, problems

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, con, sf_dir, name):
    assert problems(spark, con, QUERIES[name], SQL.get(name), sf_dir) == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_has_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert bad not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["categoria", "ventas", "unidades", "margen_pct"]


def test_inputs_use_the_whole_tables(spark):
    """At sf0.01 there are 2,000 dishes and 100 employees, more than any modulus could hide."""
    t = Tables(spark, "/root/testdata/sf0.01")
    dishes, sellers = t.part.count(), t.supplier.count()
    spelled = bindings.feed(t).select(text.norm_name(F.col("plato")).alias("nombre"), "plato").distinct().groupBy("nombre").count()
    bought = t.events.filter("event_type = 'purchase'").count()
    assert spelled.count() > min(200, dishes // 2, bought // 2) and spelled.filter("count > 1").count() > 0
    assert bindings.pedidos(t).select("id_empleado").distinct().count() == sellers
    assert bindings.stg_pedido(t).select("id_empleado").distinct().count() == sellers
    keyed = bindings._with_dish_key(t.events, t)
    assert keyed.select("dish_key").distinct().count() == dishes
    assert keyed.join(t.part.withColumnRenamed("p_partkey", "dish_key"), "dish_key", "left_anti").count() == 0


def test_building_a_query_builds_only_what_it_reads(spark, sf_dir):
    session.clear_staging(spark)
    QUERIES["o07_top_dishes"](spark, sf_dir)
    assert not bindings.star(Tables(spark, sf_dir))._built
    assert QUERIES["p10_own_channels"](spark, sf_dir).count() > 0
    session.clear_staging(spark)
    assert QUERIES["p10_own_channels"](spark, sf_dir).count() > 0  # built again, not read from what is gone


def test_star_has_no_sale_outside_its_dimensions(spark, sf_dir):
    tables = bindings.build_star(Tables(spark, sf_dir))
    assert warehouse.star_view(tables).count() == tables["fact_ventas"].count()
    days = tables["dim_fecha"].agg(F.min("fecha"), F.max("fecha")).first()
    assert days[0].month == days[0].day == 1 and days[1] >= bindings.LOAD_DATE
    easter = {r.fecha for r in bindings.holidays(Tables(spark, sf_dir)).filter("feriado = 'Viernes Santo'").collect()}
    assert {dt.date(2026, 4, 3), dt.date(2024, 3, 29), dt.date(2000, 4, 21)} <= easter


def test_gates_stop_a_broken_star(spark, sf_dir):
    tables = dict(bindings.star(Tables(spark, sf_dir)))
    cut = dict(tables, dim_plato=tables["dim_plato"].filter("sk_plato > 5"))
    with pytest.raises(quality.ValidationError):
        warehouse.check_star(cut)
    blank = dict(tables, fact_ventas=tables["fact_ventas"].withColumn("sk_canal", F.lit(None).cast("int")))
    with pytest.raises(quality.ValidationError):
        warehouse.check_star(blank)


def test_unfiltered_lines_are_not_shuffled(spark, sf_dir):
    """Broadcasting off: below the sums, the lines meet the chosen orders first."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("a03_sales_by_category", "o03_slice_channel", "o04_dice_flat"):
            plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
            assert "LeftSemi" in plan, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
