"""Micro-batch order intake with one state per order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import intake, joins, quality
from ..operators.audit import audit_rows

# Reasons.
REPEATED = "El pedido ya fue procesado"
NO_ORDER = "Línea sin pedido"

# Open orders and decided ids lie on the executors' disks; 256 MB an executor serve all its partitions,
# beside the heap.  The default store would hold every key, in two versions, as objects on the heap.
_STORE = "spark.sql.streaming.stateStore."
STATE = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}rocksdb.maxMemoryUsageMB": "256",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}rocksdb.allowFAllocate": "false",  # else each partition's files begin with megabytes of nothing
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Settings for a query started meanwhile; it keeps them.  Those the session has are left as they are."""
    added = [key for key in STATE if spark.conf.get(key, None) is None]
    for key in added:
        spark.conf.set(key, STATE[key])
    try:
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def _write(df: DataFrame, path: str, table: str, batch_id: int) -> DataFrame:
    """Each batch owns one folder, so a batch that runs again replaces only its own rows."""
    target = f"{path}/{table}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def _reject(df: DataFrame, table: str, key: str, reason: str) -> DataFrame:
    return df.select(F.lit(table).alias("tabla"), F.col(key).cast("bigint").alias("id_registro"), F.lit(reason).alias("motivo"))


def arrival(tick: Column, gap: str) -> Column:
    """Clock of a file source: when a line's file came; a row where ``tick`` holds closes whatever came before it."""
    came = F.col("_metadata.file_modification_time")
    return F.when(tick, came + F.expr(f"INTERVAL {gap}") + F.expr("INTERVAL 1 SECOND")).otherwise(came)


def closed_orders(lines: DataFrame, clock: str, gap: str) -> DataFrame:
    """Streaming frame ``id_pedido, primera, desde, lineas`` of the orders that are complete.

    An order is complete when the clock has gone ``gap`` past its last line;
    until then its lines wait in the state store, from whichever files they
    came.  Each complete order gives a row with its lines.  A row ``primera``
    comes with it, unless the id was complete once before: the second state
    keeps nothing but the ids.
    """
    body = F.struct(*[F.col(c) for c in lines.columns if c != clock])
    session = F.session_window(clock, gap)
    orders = (lines.withWatermark(clock, "0 seconds").groupBy(session.alias("sesion"), "id_pedido")
              .agg(F.collect_list(body).alias("lineas")))
    rows = orders.select("id_pedido", F.col("sesion.start").alias("desde"), "lineas", F.explode(F.array(F.lit(True), F.lit(False))).alias("primera"))
    # Under ``primera`` one row per id survives, else each session does, as its start is its own.
    return rows.select("id_pedido", "primera", F.when(~F.col("primera"), F.col("desde")).alias("desde"),
                       F.when(~F.col("primera"), F.col("lineas")).alias("lineas")).dropDuplicates(["id_pedido", "primera", "desde"])


def stream_intake(source: DataFrame, catalog: DataFrame, path: str, checkpoint: str,
                  split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], clock: str = "hora", gap: str = "10 minutes") -> None:
    """Drain ``source``, a stream of order lines with a ``clock``, through the order intake.

    Orders are decided whole: a batch takes up the orders that are complete by
    then, wherever their lines came from.  ``split`` turns the lines of these
    orders into (orders, lines).  Good rows, rejects and audit rows land below
    ``path``; the complete orders and the priced lines are written first, and the
    other outputs read them back.  A row in ``lotes`` marks a finished batch.

    An order is decided once, accepted or refused, by the first lines that are
    complete under its id; later ones of the same id are logged as a repeat.
    Lines without an order id are logged one by one.  A row without line and
    order id is a tick: it only moves the clock.  Lines behind the clock by more
    than ``gap`` would be left out by the state store, so they stop the drain;
    with ``arrival`` as the clock there are none.

    Scale: what is open is in the state store, what was decided is there as a
    bare id, both dealt by order id.  A batch reads its own files, changes its
    own orders' states and looks at no earlier batch, so the thousandth costs
    what the first does.  The states lie on disk (``STATE``), unless the session
    names a state store of its own.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        closed = _write(batch, path, "cerrados", batch_id)
        if batch_id and closed.isEmpty():  # the first batch leaves its empty tables, so that readers find their columns
            _write(spark.range(1).select(F.lit("listo").alias("estado")), path, "lotes", batch_id)
            return
        sessions = closed.filter(~F.col("primera"))
        # Ids are a small part of the files Spark measures, and a batch is planned without AQE: what grows with
        # its orders is joined by sorting, never broadcast.
        new = closed.filter("primera AND id_pedido IS NOT NULL").select("id_pedido").distinct().hint("merge")
        # Two sessions of an id may close in the same batch: the earlier one counts.
        first = joins.keep_accepted(sessions, new).groupBy("id_pedido").agg(F.min("desde").alias("desde")).hint("merge")
        taken = _write(sessions.join(first, ["id_pedido", "desde"], "left_semi").select("id_pedido", "desde", F.explode("lineas").alias("linea")),
                       path, "lineas", batch_id)
        orders, lines = split(taken.select("linea.*"))
        repeated = sessions.filter("id_pedido IS NOT NULL").join(first, ["id_pedido", "desde"], "left_anti")
        loose = sessions.filter("id_pedido IS NULL").select(F.explode("lineas").alias("linea")).select("linea.*").filter("id_detalle IS NOT NULL")

        priced = _write(intake.price_lines(lines, catalog), path, "cotizado", batch_id)
        decided, _ = intake.decide_orders(orders.hint("merge"), priced)
        good, bad = quality.validate_amounts(decided, "quarantine")
        accepted = _write(good, path, "pedidos", batch_id).hint("merge")
        refused = first.select("id_pedido").join(accepted.select("id_pedido"), "id_pedido", "left_anti")
        kept, mismatched = quality.validate_lines(intake.accepted_lines(priced, accepted), "quarantine")
        _write(kept, path, "detalle", batch_id)
        errors = (
            intake.intake_errors(priced, accepted, joins.find_orphans(refused, bad.hint("merge")))
            .unionByName(_reject(bad, "Pedido", "id_pedido", quality.BAD_AMOUNT))
            .unionByName(_reject(mismatched, "Detalle_Pedido", "id_detalle", quality.BLOCKED_LINES))
            .unionByName(_reject(repeated, "Pedido", "id_pedido", REPEATED))
            .unionByName(_reject(loose, "Detalle_Pedido", "id_detalle", NO_ORDER)))
        _write(errors, path, "errores", batch_id)
        _write(audit_rows(accepted, "Alta de pedido", "id_pedido", "Pedido", None, F.col("monto_total")),
               path, "auditoria", batch_id)
        _write(spark.range(1).select(F.lit("listo").alias("estado")), path, "lotes", batch_id)

    with _state_on_disk(source.sparkSession):
        query = (
            closed_orders(source, clock, gap).writeStream.foreachBatch(run)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
    query.awaitTermination()
    late = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    if late:
        raise quality.ValidationError(f"{late} líneas llegaron después del cierre de su pedido")


def read_result(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Rows of finished batches only."""
    done = spark.read.parquet(f"{path}/lotes").select("batch_id")
    return spark.read.parquet(f"{path}/{table}").join(done, "batch_id", "left_semi")
