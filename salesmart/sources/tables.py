"""The shared test tables; Parquet footers carry their schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ..session import configure
from .schemas import TABLES


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


class Tables:
    """``Tables(spark, dir).orders`` is a lazy scan of ``dir/orders.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        # Footers are read once per session and table, not once per query.
        key = (self.spark.sparkContext.applicationId, self.path(name))
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(self.path(name)).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(self.path(name))

    def register(self) -> None:
        """Temp views, so SQL text can be run against the tables."""
        for name in TABLES:
            getattr(self, name).createOrReplaceTempView(name)
