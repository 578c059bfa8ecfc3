"""Sinks."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import stage


def write_star(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """One folder per table.  Parquet is the primary form, CSV the exchange form.

    CSV files are compressed (``part-*.csv.gz``): as plain text the fact alone takes
    several times what it was built from.  A file is what one task wrote, so that
    it cannot be split does not matter to readers.

    The fact is stored in date-key order within each file, so row-group
    statistics prune date ranges.
    """
    for name, df in tables.items():
        if name == "fact_ventas":
            df = df.sortWithinPartitions("sk_fecha")
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{path}/{name}")
        else:
            writer.parquet(f"{path}/{name}")


MANIFEST = "publicado"
MOST_TABLES = 100  # tables of one run


def publish(tables: dict[str, DataFrame], root: str) -> str:
    """Publish several tables below ``root`` together, as CSV with header; the name of the run.

    Each run writes folders of its own; its manifest, one row per table, is
    written last and by one committed job.  Until then readers see the run
    before, so a run that ends half-way is never seen, and may be repeated.
    """
    if not 0 < len(tables) <= MOST_TABLES:
        raise ValueError(f"a run publishes 1 to {MOST_TABLES} tables")
    spark = next(iter(tables.values())).sparkSession
    run = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.option("header", True).option("escape", '"').csv(f"{root}/{run}/{name}")
    rows = [(run, n, name, df.schema.json()) for n, (name, df) in enumerate(tables.items())]
    manifest = spark.createDataFrame(rows, "corrida string, orden int, tabla string, esquema string")
    manifest.coalesce(1).withColumn("momento", F.current_timestamp()).write.mode("append").parquet(f"{root}/{MANIFEST}")
    return run


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the latest published run, with the columns they were written with; empty before the first.

    A reader keeps its run while later ones are published.  An empty text reads
    as missing, as CSV has one form for both.
    """
    try:
        rows = spark.read.parquet(f"{root}/{MANIFEST}").orderBy(F.desc("momento"), F.desc("corrida"), "orden").limit(MOST_TABLES).collect()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return {}
    last = [row for row in rows if row.corrida == rows[0].corrida]
    read = lambda row: spark.read.schema(T.StructType.fromJson(json.loads(row.esquema))).option("header", True).option("escape", '"')
    return {row.tabla: read(row).csv(f"{root}/{row.corrida}/{row.tabla}") for row in last}


def as_export_text(df: DataFrame) -> DataFrame:
    """Every column as text: dates yyyy-MM-dd, times HH:mm:ss."""
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "HH:mm:ss")
        columns.append(c.cast("string").alias(field.name))
    return df.select(*columns)


def export_csv(df: DataFrame, path: str) -> None:
    as_export_text(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_step_log(log: DataFrame, path: str) -> None:
    """Append the ETL step log as CSV and as one text line per step; the log is evaluated once."""
    log = stage(log, "step-log")
    log.write.mode("append").option("header", True).option("escape", '"').csv(f"{path}/csv")
    line = F.format_string(
        "%s [%s] %s | in=%d out=%d afectadas=%d", F.date_format("marca_tiempo", "yyyy-MM-dd HH:mm:ss"),
        "paso", "descripcion", "filas_in", "filas_out", "filas_afectadas")
    log.select(line.alias("value")).write.mode("append").text(f"{path}/text")


def append_audit(df: DataFrame, path: str) -> None:
    """Add rows to the audit log.  No update, delete or overwrite is offered."""
    df.write.mode("append").parquet(path)
