"""Session settings the operators rely on, and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings.  Skewed sort-merge joins are split by AQE even when the
# split costs one more shuffle, because a hot order or dish may hold a large
# part of the lines.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_root: dict[str, str] = {}
_kept: dict[str, dict] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "salesmart", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="salesmart-"))
        .config("spark.sql.shuffle.partitions", cores)
        # Compiled stages of all queries stay in the cache, not just the last hundred.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="salesmart-")
    return _local_root[app]


def staging_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/salesmart/{app}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts lineage: the rows, and any partition numbers stored in them, stay
    the same when an executor is lost, and later readers scan only the columns
    they need.
    """
    spark = df.sparkSession
    path = staging_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, key: tuple, build):
    """What ``build`` returned for ``key`` in this application, until its staging is cleared."""
    kept = _kept.setdefault(spark.sparkContext.applicationId, {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def clear_staging(spark: SparkSession) -> None:
    """Drop everything this application staged, and what was kept that reads it."""
    _kept.pop(spark.sparkContext.applicationId, None)
    path = f"{shared_root(spark)}/salesmart/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
