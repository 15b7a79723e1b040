"""Key lookups from a large table into a dimension.

A dimension is broadcast only when its size is known to be small: from the
caller (e.g. the row count observed when the dimension was written) or from a
bounded count (``limit(n + 1).count()`` reads at most n + 1 rows). A dimension
beyond that
is joined with a shuffle, and the fact's hot key values -- any value holding at
least 1/HOT_SLOTS of the fact rows, hence at most HOT_SLOTS of them -- are
split off first and looked up through a broadcast of just their dimension rows,
so no reducer receives a hot key's rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.session import materialize, tuning

BROADCAST_ROWS = 200_000
HOT_SLOTS = 10_000


def bounded_count(df: DataFrame, limit: int) -> int | None:
    """Row count of ``df`` if it is at most ``limit``, else None."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    eq_keys: list[str],
    nullsafe_keys: list[str],
    value_cols: list[str],
    broadcast_rows: int | None = None,
    hot_slots: int | None = None,
    dim_rows: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Left join ``fact`` to ``dim`` and append ``value_cols`` of the matching row.

    ``eq_keys`` match with ``=`` (a null never matches); ``nullsafe_keys`` match
    with IS NOT DISTINCT FROM. ``dim`` must be unique on its keys, so the
    result has exactly the rows of ``fact``. ``dim_rows``, when the caller
    already knows the dimension's size (e.g. from its write), skips the count.
    ``keys_from`` has the same key columns, row for row, as ``fact`` and is
    cheaper to read (e.g. the files ``fact`` was joined from): a large
    dimension's hot keys are counted there.
    """
    spark = fact.sparkSession
    if broadcast_rows is None:
        broadcast_rows = tuning(spark, "broadcastRows", BROADCAST_ROWS)
    if hot_slots is None:
        hot_slots = tuning(spark, "hotSlots", HOT_SLOTS)
    keys = eq_keys + nullsafe_keys
    d = dim.select(*[F.col(k).alias(f"_d_{k}") for k in keys], *value_cols)

    def cond(left: DataFrame, right: DataFrame) -> Column:
        return _all(
            [left[k] == right[f"_d_{k}"] for k in eq_keys]
            + [left[k].eqNullSafe(right[f"_d_{k}"]) for k in nullsafe_keys]
        )

    def join(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, cond(left, right), "left").select(*left.columns, *value_cols)

    small = dim_rows <= broadcast_rows if dim_rows is not None else bounded_count(dim, broadcast_rows) is not None
    if small:
        return join(fact, F.broadcast(d))

    # Large dimension: find the hot key values (partial aggregation keeps this
    # shuffle to one row per key and map task), at most hot_slots of them.
    source = (fact if keys_from is None else keys_from).select(*keys)
    per_key = materialize(source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")), "key-counts", df_schema=True)
    n = int(per_key.agg(F.sum("_cnt")).first()[0] or 0)
    threshold = max(1, -(-n // hot_slots))
    hot = materialize(per_key.where(F.col("_cnt") >= threshold).select(*keys), "hot-keys", df_schema=True)
    hot_b = F.broadcast(hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys]))

    def is_hot(left: DataFrame, prefix: str = "") -> Column:
        return _all([left[f"{prefix}{k}"].eqNullSafe(hot_b[f"_h_{k}"]) for k in keys])

    fact_hot = fact.join(hot_b, is_hot(fact), "left_semi")
    fact_cold = fact.join(hot_b, is_hot(fact), "left_anti")
    dim_hot = d.join(hot_b, is_hot(d, "_d_"), "left_semi")
    return join(fact_hot, F.broadcast(dim_hot)).unionByName(join(fact_cold, d))
