"""Readers for the raw feeds: CSV, all-string staging, JSON, JSON lines, Parquet star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text
from . import schemas


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed CSV with a header; a UTF-8 BOM is skipped and "" inside quotes is a quote."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_staging(spark: SparkSession, path: str, columns: list[str], header: bool = True, broken: str | None = None) -> DataFrame:
    """Every column as text; short or long lines do not stop the load.

    With ``broken``, a column of that name holds the text of each line that has
    too few or too many fields, and NULL for whole lines.  Every field of a line
    is then parsed, whatever columns are asked for, as a pruned read would not
    see that fields are missing.  Empty lines are skipped by the reader.
    """
    schema = schemas.all_strings(*columns)
    reader = (
        spark.read.option("header", header)
        .option("sep", ",")
        .option("lineSep", "\n")
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if broken is None:
        return reader.schema(schema).csv(path)
    checked = (
        reader.schema(f"{schema}, {schemas.all_strings(broken)}")
        .option("columnNameOfCorruptRecord", broken)
        .option("columnPruning", False)
        .csv(path)
    )
    # Always true, but names a field: the reader refuses queries of the broken text alone, counts among them.
    read = F.length(F.concat_ws("", columns[0])) >= 0
    return checked.withColumn(broken, F.when(read, F.col(broken)))


def split_broken(staging: DataFrame, broken: str) -> tuple[DataFrame, DataFrame]:
    """(whole lines without the column, broken lines with it) of a checked staging read."""
    return staging.filter(F.col(broken).isNull()).drop(broken), staging.filter(F.col(broken).isNotNull())


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents stored as one JSON array per file; absent fields come out NULL.

    A multi-line file cannot be split, so large collections belong in JSON lines.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows written in the program.

    Built from literals, so the planner knows they are small and broadcasts
    them; a frame made from a Python list has no size estimate and would be
    shuffled on its few keys.
    """
    columns = schemas.fields(schema)
    cells = [F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, columns, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def literal_dim(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small dimension given as rows; its first column is numbered from 1."""
    return literal_rows(spark, [(i, *row) for i, row in enumerate(rows, 1)], schema)


def load_master(df: DataFrame) -> DataFrame:
    """Employee master: id padded to eight, blank or malformed salary to NULL."""
    return df.withColumns({
        "dni_empleado": text.pad_id(F.col("dni_empleado")),
        "salario_mensual": text.safe_cast(F.col("salario_mensual"), "decimal(10,2)"),
    })


def load_star(spark: SparkSession, path: str, fmt: str = "parquet",
              names: list[str] | None = None) -> dict[str, DataFrame]:
    """The star tables below ``path`` (all by default); empty CSV text is read as NULL."""
    tables = {}
    for name in names or schemas.STAR:
        schema = schemas.STAR[name]
        if fmt == "csv":
            reader = spark.read.schema(schema).option("header", True).option("nullValue", "").option("escape", '"')
            tables[name] = reader.csv(f"{path}/{name}")
        else:
            tables[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
    return tables


def register_star(tables: dict[str, DataFrame]) -> None:
    """Temp views named like the tables, ready for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
