import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from salesmart.operators import quality
from salesmart.plans import streaming
from salesmart.sources.tables import Tables
from salesmart.streaming import intake_stream, read_result, stream_intake

LINES = "hora timestamp, id_detalle bigint, id_pedido bigint, id_plato bigint, cantidad int"
START = dt.datetime(2024, 5, 1, 12)


class Intake:
    """Lines are put in files by hand, a minute of the clock each; an order closes ten minutes after its last line."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.minute = spark, folder, 0
        menu = spark.createDataFrame([(1, 28), (9, 35)], "id_plato bigint, p int")
        self.menu = menu.select("id_plato", F.col("p").cast("decimal(12,2)").alias("precio_base"))

    def feed(self, *rows, minutes=1):
        self.minute += minutes
        at = START + dt.timedelta(minutes=self.minute)
        self.spark.createDataFrame([(at, *r) for r in rows], LINES).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def tick(self):
        self.feed((None, None, None, None), minutes=11)

    def drain(self, checkpoint="c", out="out"):
        def split(lines):
            return lines.select("id_pedido", F.lit(None).cast("bigint").alias("id_cliente")).distinct(), lines

        source = self.spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")
        stream_intake(source, self.menu, f"{self.folder}/{out}", f"{self.folder}/{checkpoint}", split)

    def result(self, table, *columns, out="out"):
        return sorted(tuple(r) for r in read_result(self.spark, f"{self.folder}/{out}", table).selectExpr(*columns).collect())

    def forget_last_commit(self, copy):
        """A checkpoint whose last batch was written but not committed, as after a lost driver."""
        shutil.copytree(f"{self.folder}/c", f"{self.folder}/{copy}")
        last = max(int(p.name) for p in (self.folder / copy / "commits").iterdir() if p.name.isdigit())
        (self.folder / copy / "commits" / str(last)).unlink()
        (self.folder / copy / "commits" / f".{last}.crc").unlink(missing_ok=True)


TOTAL = "CAST(monto_total AS INT)"


def test_batches_add_up_and_rerun_cleanly(spark, tmp_path):
    intake = Intake(spark, tmp_path)
    intake.feed((1, 100, 1, 2), (2, 100, 999, 1), (3, 101, 999, 1))
    intake.tick()
    intake.drain()
    assert intake.result("pedidos", "id_pedido", "id_cliente", TOTAL) == [(100, 9999, 56)]
    assert [r[:2] for r in intake.result("errores", "tabla", "id_registro", "motivo")] == [("Detalle_Pedido", 2), ("Pedido", 101)]

    intake.feed((4, 102, 9, 1))
    intake.tick()
    intake.drain()
    assert intake.result("pedidos", "id_pedido", TOTAL) == [(100, 56), (102, 35)]
    assert intake.result("auditoria", "accion") == [("Alta de pedido 100",), ("Alta de pedido 102",)]

    intake.forget_last_commit("c2")  # its folder is replaced, nothing doubles
    intake.drain("c2")
    assert intake.result("pedidos", "id_pedido") == [(100,), (102,)]
    assert len(intake.result("detalle", "id_detalle")) == 2


def test_an_order_over_several_files_is_decided_whole(spark, tmp_path):
    intake = Intake(spark, tmp_path)
    # 100 comes in three files, 101 is valid only by its second file, 103 by none of its two.
    intake.feed((1, 100, 1, 2), (2, 101, 999, 1), (7, 103, 999, 1))
    intake.feed((3, 100, 9, 1), (4, 101, 1, 1), (8, 103, 1, 0))
    intake.drain()
    assert read_result(spark, f"{tmp_path}/out", "pedidos").count() == 0  # open, in the state store
    intake.feed((5, 100, 1, 1), (6, 102, 1, 1))
    intake.drain()
    intake.tick()
    intake.drain()
    assert intake.result("pedidos", "id_pedido", TOTAL) == [(100, 119), (101, 28), (102, 28)]
    assert intake.result("detalle", "id_detalle") == [(1,), (3,), (4,), (5,), (6,)]
    assert intake.result("errores", "tabla", "id_registro", "motivo") == [
        ("Detalle_Pedido", 2, "Plato inexistente"), ("Pedido", 103, "El pedido no tiene líneas válidas")]


def test_a_repeated_order_is_logged_and_earlier_batches_are_not_read(spark, tmp_path):
    intake = Intake(spark, tmp_path)
    intake.feed((1, 100, 1, 2), (2, 101, 999, 1))
    intake.tick()
    intake.drain()
    for n in range(3):  # other orders in between
        intake.feed((10 + n, 200 + n, 1, 1))
        intake.tick()
    # 100 was accepted, 101 refused; both are known from the state, the results of earlier batches lie elsewhere.
    intake.feed((3, 100, 9, 5), (4, 101, 1, 1), (5, 300, 1, 1), (6, None, 1, 1))
    intake.tick()
    intake.drain(out="other")
    assert intake.result("pedidos", "id_pedido", out="other") == [(200,), (201,), (202,), (300,)]
    want = [(6, "Línea sin pedido"), (100, "El pedido ya fue procesado"), (101, "El pedido ya fue procesado")]
    assert intake.result("errores", "id_registro", "motivo", out="other") == want
    assert intake.result("pedidos", "id_pedido", TOTAL) == [(100, 56)]

    # Twice in one batch, ten minutes apart: the earlier request counts.
    intake.feed((20, 400, 1, 1))
    intake.feed((21, 400, 9, 1), minutes=15)
    intake.tick()
    intake.drain(out="last")
    assert intake.result("pedidos", "id_pedido", TOTAL, out="last") == [(400, 28)]
    assert intake.result("errores", "id_registro", "motivo", out="last") == [(400, "El pedido ya fue procesado")]


def test_lines_behind_the_clock_stop_the_drain(spark, tmp_path):
    intake = Intake(spark, tmp_path)
    intake.feed((1, 100, 1, 2))
    intake.tick()
    intake.drain()
    intake.feed((2, 100, 1, 2), minutes=-11)
    intake.feed((3, 101, 1, 2), minutes=11)
    with pytest.raises(quality.ValidationError, match="después del cierre"):
        intake.drain()


def test_states_lie_on_disk_and_orders_are_not_broadcast(spark, tmp_path, monkeypatch):
    plans, write = {}, intake_stream._write
    monkeypatch.setattr(intake_stream, "_write", lambda df, path, table, batch_id: (
        plans.update({(table, batch_id): df._jdf.queryExecution().executedPlan().toString()}), write(df, path, table, batch_id))[1])
    intake = Intake(spark, tmp_path)
    intake.feed((1, 100, 1, 2), (2, 101, 999, 1))
    intake.tick()
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    intake.drain()
    assert intake.result("pedidos", "id_pedido") == [(100,)]
    assert spark.conf.get(provider, None) == before  # the session is as it was
    assert "RocksDBStateStoreProvider" in (tmp_path / "c" / "offsets" / "0").read_text()
    assert any("SortMergeJoin" in plan for (table, _), plan in plans.items() if table == "detalle")
    assert not [key for key, plan in plans.items() if key[0] != "cotizado" and "BroadcastHashJoin" in plan]  # the menu may be


def test_files_do_not_come_with_the_shuffle_partitions(spark, tmp_path, monkeypatch):
    schemas = {
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
        "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"}
    rows = {"lineitem": [(n // 3, n, 1, n % 3, 2.0, 9.0, 0.0, 0.0, "N", "O", START) for n in range(120)]}
    for name, schema in schemas.items():
        spark.createDataFrame(rows.get(name, []), schema).write.parquet(f"{tmp_path}/{name}.parquet")
    seen = {}
    monkeypatch.setattr(streaming, "stream_intake", lambda source, catalog, path, *_: seen.update(path=path))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        streaming._drain(Tables(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    given = spark.read.parquet(seen["path"].removesuffix("/out") + "/in")
    # All lines and the tick; an order's lines lie in several files, and the files are fewer than the 60 partitions.
    assert given.count() == 121
    assert streaming.FILES_PER_BATCH < given.select(F.input_file_name()).distinct().count() < 30
