"""The star that queries read stands behind its gates."""

import pytest
from pyspark.sql import functions as F

from salesmart import session
from salesmart.operators import quality, warehouse
from salesmart.plans import bindings, queries
from salesmart.sources.tables import Tables


@pytest.mark.parametrize("broken", ["cast(null as int)", "99"])
def test_star_view_stops_on_a_key_without_member(spark, sf_dir, monkeypatch, broken):
    build = bindings.Star._fact_ventas
    monkeypatch.setattr(bindings.Star, "_fact_ventas", lambda self: build(self).withColumn("sk_canal", F.expr(broken)))
    session.clear_staging(spark)
    for _ in range(2):  # a refused fact is not kept
        with pytest.raises(quality.ValidationError):
            queries()["j02_star_view"](spark, sf_dir)
    session.clear_staging(spark)


def test_gates_read_the_fact_once_and_name_what_is_wrong(spark, sf_dir):
    star = dict(bindings.build_star(Tables(spark, sf_dir)))
    fact = star["fact_ventas"].withColumns({
        "sk_canal": F.when(F.col("sk_venta") % 10 == 0, F.lit(None)).otherwise(F.col("sk_canal")),
        "sk_turno": F.when(F.col("sk_venta") <= 3, F.lit(99)).when(F.col("sk_venta") <= 5, F.lit(98)).otherwise(F.col("sk_turno"))})
    faults = warehouse.key_faults(star | {"fact_ventas": fact})
    rows = fact.count()
    want = {key: (0, 0) for key in warehouse.FACT_KEYS} | {"sk_canal": (rows // 10, 0), "sk_turno": (0, 2)}
    assert {r.columna: (r.nulos, r.faltantes) for r in faults.collect()} == want
    leaves = star["fact_ventas"]._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    dims = sum(star[d]._jdf.queryExecution().optimizedPlan().collectLeaves().size() for d in warehouse.FACT_KEYS.values())
    plan = warehouse.key_faults(star)._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == leaves + dims + 1  # the fact, each dimension, the seven names
    none = warehouse.key_faults(star | {"fact_ventas": fact.limit(0)})
    assert {(r.nulos, r.faltantes) for r in none.collect()} == {(0, 0)} and none.count() == 7
