"""Column statistics that stay distributed at any size.

* null counts: one combinable global aggregate (or an observation riding on a
  write that happens anyway). A NaN counts as a missing value.
* exact median: Spark's ``median`` keeps every distinct value of a column in
  the single task that finishes a global aggregate. Here ``(value, count)``
  pairs (map-side combined) are range-partitioned and written; the partition
  totals tell which partition holds the middle ranks, and a running count
  inside that partition finds the values.
* mode: ``(column, value) -> count`` (map-side combined), then per column the
  largest count, smallest value on ties; all columns in one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.functions.columns import is_missing, nan_as_null
from civicspark.session import materialize


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass
class Profile:
    """Row count and missing values (null or NaN) per column."""

    rows: int
    nulls: dict[str, int]


def profile_exprs(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Aggregates for :func:`read_profile`: usable in ``agg`` or ``observe``."""
    cols = df.columns if columns is None else columns
    exprs = [F.count(F.lit(1)).alias("_rows")]
    return exprs + [F.count_if(is_missing(_c(c), df.schema[c].dataType)).alias(f"_null{i}") for i, c in enumerate(cols)]


def read_profile(values: dict, columns: list[str]) -> Profile:
    return Profile(rows=int(values["_rows"]), nulls={c: int(values[f"_null{i}"]) for i, c in enumerate(columns)})


def profile(df: DataFrame) -> Profile:
    """Row count and missing values per column in one aggregate."""
    return read_profile(df.agg(*profile_exprs(df)).first().asDict(), list(df.columns))


def median_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, median)`` per column that has a value (G6): NaN and null are skipped.

    One job writes the counted values in range partitions (so that sampled
    boundaries cannot move when a task is run again), a folder per column and
    partition; the plan returned reads them. Totals are one row per partition
    and column; only the files of the at most two partitions per column with a
    middle rank are read for their values.
    """
    cols = list(columns)
    value = {c: nan_as_null(_c(c).cast("double"), T.DoubleType()) for c in cols}
    cells = F.array(*[F.when(value[c].isNotNull(), F.struct(F.lit(j).alias("c"), value[c].alias("v"))) for j, c in enumerate(cols)])
    counted = (
        df.select(F.explode(cells).alias("cell"))
        .where(F.col("cell").isNotNull())
        .groupBy("cell.c", "cell.v")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counted.repartitionByRange(n, "c", "v").withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "counted-values", df_schema=True, partition_by=["c", "part"])

    totals = ranged.groupBy("c", "part").agg(F.sum("cnt").alias("total"))  # reads the counts only
    by_part = Window.partitionBy("c").orderBy("part")
    totals = totals.select(
        "c", "part", "total",
        (F.sum("total").over(by_part) - F.col("total")).alias("below"),
        F.sum("total").over(Window.partitionBy("c")).alias("n"),
    )
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middle = totals.where((F.col("below") <= high) & (F.col("below") + F.col("total") > low))

    # Few parts hold a middle rank. They are folders, so the join prunes the files of all others before they are read.
    inside = ranged.join(F.broadcast(middle.select("c", "part", "below", "n")), ["c", "part"])
    running = Window.partitionBy("c", "part").orderBy("v")
    upto = inside.withColumn("upto", F.col("below") + F.sum("cnt").over(running))
    first = F.col("upto") - F.col("cnt")
    picked = upto.where((first <= high) & (F.col("upto") > low)).groupBy("c").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    names = F.array(*[F.lit(c) for c in cols])
    mean = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((F.col("a") + F.col("b")) / 2)
    return picked.select(F.element_at(names, F.col("c") + 1).alias("column_name"), mean.alias("median"))


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact median per column, missing values skipped, even count -> mean of the middle two."""
    cols = list(columns)
    if not cols:
        return {}
    found = {r["column_name"]: r["median"] for r in median_table(df, cols).collect()}  # one row per column
    return {c: found.get(c) for c in cols}


def modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent non-null value per column, smallest value on ties (G7). One job."""
    cols = list(columns)
    if not cols:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = F.array(
        *[F.when(_c(c).isNotNull(), F.struct(F.lit(j).alias("c"), _c(c).cast("string").alias("v"))) for j, c in enumerate(cols)]
    )
    counted = (
        df.select(F.explode(cells).alias("cell"))
        .where(F.col("cell").isNotNull())
        .groupBy("cell.c", "cell.v")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    # Largest count first, then the smallest value: the minimum of (-count, value).
    best = counted.groupBy("c").agg(F.min(F.struct((-F.col("cnt")).alias("k"), F.col("v").alias("v"))).alias("b"))
    found = {cols[r["c"]]: r["b"]["v"] for r in best.collect()}  # one row per column
    out: dict[str, object] = {}
    for c in cols:
        v = found.get(c)
        out[c] = None if v is None else _typed(v, types.get(c))
    return out


def _typed(v: str, dtype: T.DataType | None) -> object:
    if dtype is None or isinstance(dtype, T.StringType):
        return v
    if isinstance(dtype, T.BooleanType):
        return v == "true"
    return v


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """One row: rows beyond the first per key value, null keys counted as equal."""
    per_key = df.groupBy(_c(key)).agg(F.count(F.lit(1)).alias("cnt"))
    return per_key.agg(F.coalesce(F.sum(F.col("cnt") - F.lit(1)), F.lit(0)).cast("bigint").alias("n_duplicates"))
