"""Query registry."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.tables import Tables

_BUILD: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}

MODULES = ["scans", "filters", "joins", "aggregates", "windows", "sets", "scalars", "quality",
           "warehouse", "kpis", "olap", "audit", "documents", "access", "surface", "streaming", "volume"]


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with the SQL that must give the same rows."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in _BUILD:
            raise ValueError(f"query {name} is registered twice")
        _BUILD[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")


def published(df: DataFrame) -> DataFrame:
    """Amounts leave as DOUBLE; every other type stays."""
    decimals = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(decimals) if decimals else df


def _runner(fn: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return published(fn(Tables(spark, sf_dir)))
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: _runner(fn) for name, fn in _BUILD.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
