"""Session construction and the shared scratch area.

Intermediate tables (stable surrogate-key staging, cleaned stages, round-trip
outputs) are written under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent and Spark runs in
local mode (tests, laptops) is a fresh temporary folder used instead.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(
    master: str = "local[8]",
    app_name: str = "civicspark",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    extra: dict | None = None,
) -> SparkSession:
    """A session with the settings the engine is tested under.

    AQE stays on (runtime coalescing and skew-join splitting). The session
    time zone is UTC, although no engine step depends on it (timestamps are
    zone-less end to end).
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master.startswith("local"):
        # One host: waiting for a "better" locality level only delays tasks.
        builder = builder.config("spark.locality.wait", "0s")
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, taken from the session's checkpoint dir."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder shared by all executors"
            )
        configured = tempfile.mkdtemp(prefix="civicspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


_SCOPE = "civicspark.scratch.scope"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the scratch root (or the current scratch scope)."""
    scope = spark.sparkContext.getLocalProperty(_SCOPE)
    base = scope or f"{scratch_root(spark)}/civicspark"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str):
    """Put the intermediate tables written inside the block in one folder, removed at exit.

    The folder is carried as a Spark local property, which threads started
    with ``inheritable_thread_target`` inherit, so work fanned out to worker
    threads lands there too, while unrelated threads are unaffected. The
    folder is deleted whether the block succeeds or fails; nothing returned
    from the block may still read from it.
    """
    sc = spark.sparkContext
    outer = sc.getLocalProperty(_SCOPE)
    folder = scratch_path(spark, name)
    sc.setLocalProperty(_SCOPE, folder)
    try:
        yield folder
    finally:
        sc.setLocalProperty(_SCOPE, outer)
        delete_path(spark, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` through the Hadoop file system Spark writes with; a missing path is no error."""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)


def materialize(df: DataFrame, name: str, df_schema: bool = False, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the scratch root and read it back.

    This cuts lineage: later jobs read the written files (column-pruned,
    filter-pushed) instead of recomputing the plan, and a lost executor only
    costs re-reading files, never a re-run with different results. With
    ``df_schema`` no job reads the schema from the files. ``partition_by`` lays
    the files out in folders, which later filters and joins prune.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    return (spark.read.schema(df.schema) if df_schema else spark.read).parquet(path)


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """:func:`materialize` plus the number of rows written (observed during the write)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation(f"rows_{name}_{uuid.uuid4().hex[:8]}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), int(seen.get["n"])


def tuning(spark: SparkSession, name: str, default: int) -> int:
    """An integer knob read from the session conf ``civicspark.<name>``, else ``default``.

    The engine's size bounds (``broadcastRows``, ``hotSlots``, ``sliceSortRows``
    and those of the training-data operators) are set this way, e.g. to force
    every large-data path on a small input.
    """
    value = spark.conf.get(f"civicspark.{name}", None)
    return default if value is None else int(value)
