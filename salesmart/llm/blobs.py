"""Files of bytes, written and read by Spark through whatever file system the folder's path names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_blobs(rows: DataFrame, folder: str, end: str) -> None:
    """One file in ``folder`` for each row of the binary column ``body``, each followed by the ASCII text ``end``.

    Spark's own writer does it: files appear when the whole job is committed, a
    task that runs again replaces its own, and the path may lie in any store.
    The files of a task are numbered in the order of its rows.
    """
    # A cast keeps every byte; the text writer adds only the end.
    texts = rows.select(F.col("body").cast("string").alias("value"))
    texts.write.option("lineSep", end).option("maxRecordsPerFile", 1).text(folder)


def read_blobs(spark: SparkSession, folder: str) -> DataFrame:
    """``path, content`` of the files in ``folder`` that are not empty."""
    return spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")
