"""Global row numbers and dense surrogate keys, without a one-task window (W1-W3, O4),
and sums over all rows before each one.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY runs in a single
task. Here the rows are range-partitioned on the order keys, sorted inside
each partition and numbered there; the per-partition row counts (one row per
partition, so a proven bound) give each partition its offset. Over distinct
rows the row number is the dense rank.

The numbered rows are written to the scratch folder before the offsets are
taken: range boundaries are sampled, and a recomputation after a lost executor
must not move a row to another partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.session import materialize


def numbered(df: DataFrame, order: list[Column], name: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``name`` (bigint, 1-based): each row's place in the order; ties get any of their places."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    placed = materialize(placed, f"numbered-{name}", df_schema=True)

    # One row per range partition: its first position and running offset.
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
        .withColumn("_offset", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
        .select("_part", "_first", "_offset")
    )
    place = F.col("_offset") + F.col("_pos") - F.col("_first") + F.lit(1)
    return placed.join(F.broadcast(offsets), "_part").select(place.cast("bigint").alias(name), *df.columns)


def numbered_groups(df: DataFrame, group: str, order: list[Column], name: str, num_partitions: int | None = None) -> dict[object, DataFrame]:
    """For each value of ``group``: its rows of ``df`` with ``name`` (bigint, 1-based), their place in the order within it.

    All groups are range-partitioned, sorted and written together, in the order
    (group, order). Where each group begins in each partition (one number per
    group and partition) goes through the driver, so the frames returned have
    no job of their own before they are read.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group).asc_nulls_last(), *order]
    placed = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    placed = materialize(placed, f"numbered-{name}", df_schema=True)
    starts: dict[object, dict[int, int]] = {}
    done: dict[object, int] = {}
    for r in sorted(placed.groupBy(group, "_part").agg(F.min("_pos").alias("first"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["_part"]):
        before = done.get(r[group], 0)
        starts.setdefault(r[group], {})[r["_part"]] = before - r["first"] + 1
        done[r[group]] = before + r["n"]
    out = {}
    for value, by_part in starts.items():
        shift = F.element_at(F.lit([by_part.get(p, 0) for p in range(max(by_part) + 1)]).cast("array<bigint>"), F.col("_part") + 1)
        rows = placed.where(F.col(group).eqNullSafe(F.lit(value)))
        out[value] = rows.select((F.col("_pos") + shift).alias(name), *[c for c in df.columns if c != group])
    return out


def prefix_sums(df: DataFrame, order: list[Column], value: str, name: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``name`` (bigint): the sum of ``value`` over all rows before each one in the order.

    The order must be total. Range partitions are summed on their own, one
    total per partition gives each its offset, and a running sum stays inside
    a partition.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), f"prefix-{name}", df_schema=True)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.sum(value).alias("_total"))
        .select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, running.cast("bigint").alias(name))


def dense_rank_ids(df: DataFrame, order_cols: list[str], id_col: str, num_partitions: int | None = None) -> DataFrame:
    """Append ``id_col`` (bigint, 1-based) ranking the distinct rows of ``df``, nulls last.

    ``df`` must hold distinct values of ``order_cols``. ``id_col`` comes first
    in the result.
    """
    return numbered(df, [F.col(c).asc_nulls_last() for c in order_cols], id_col, num_partitions)
