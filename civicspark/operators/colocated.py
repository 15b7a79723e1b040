"""Tables laid out by a join key, so that lookups between them move no rows (J1-J3 with large dimensions).

Fact and dimension are written as bucketed tables on the hash of their key
columns, with the same number of buckets. A lookup then joins bucket with
bucket: neither side is exchanged, however large both are, and the layout
serves every later lookup by that key. The hash is the join key; the key
columns themselves are compared as well, so a hash shared by two keys finds the
right row.

A key that holds many rows would fill its bucket. The fact's hot keys -- any
value with at least 1/HOT_SLOTS of the rows, so a bounded number of them --
are kept in a plain table of their own and looked up through a broadcast of
their dimension rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.operators.joins import HOT_SLOTS
from civicspark.session import materialize, tuning

KEY_HASH = "_key_hash"


@dataclass(frozen=True)
class Colocated:
    """A table in two parts: ``name``, bucketed by the hash of its key, and the plain folder of its hot keys (None: it has none)."""

    name: str
    hot_path: str | None
    eq_keys: tuple[str, ...]
    nullsafe_keys: tuple[str, ...]
    buckets: int

    @property
    def keys(self) -> tuple[str, ...]:
        return self.eq_keys + self.nullsafe_keys

    def cold(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def hot(self, spark: SparkSession) -> DataFrame | None:
        return None if self.hot_path is None else spark.read.parquet(self.hot_path)

    def rows(self, spark: SparkSession) -> DataFrame:
        hot = self.hot(spark)
        return (self.cold(spark) if hot is None else self.cold(spark).unionByName(hot)).drop(KEY_HASH)


def key_hash(keys: tuple[str, ...]) -> Column:
    """Hash of the key columns; a null counts as a value of its own place."""
    return F.xxhash64(*[x for k in keys for x in (F.col(f"`{k}`").isNull(), F.col(f"`{k}`"))])


def save_colocated(
    df: DataFrame,
    name: str,
    path: str,
    eq_keys: tuple[str, ...],
    nullsafe_keys: tuple[str, ...] = (),
    buckets: int = 200,
    unique: bool = False,
    hot_slots: int | None = None,
) -> Colocated:
    """Write ``df`` as the table ``name`` below ``path``, one file per bucket; hot keys go beside it.

    ``unique`` says that no two rows share a key (a dimension), so none is hot.
    """
    if not name.isidentifier():
        raise ValueError(f"Invalid table name: '{name}'")
    spark, keys = df.sparkSession, tuple(eq_keys) + tuple(nullsafe_keys)
    rows = df.withColumn(KEY_HASH, key_hash(keys))
    hot_path = None
    if not unique:
        slots = tuning(spark, "hotSlots", HOT_SLOTS) if hot_slots is None else hot_slots
        counts = materialize(rows.groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias("_n")), "key-counts", df_schema=True)
        total = int(counts.agg(F.sum("_n")).first()[0] or 0)
        hot = materialize(counts.where(F.col("_n") >= max(2, -(-total // slots))).select(KEY_HASH), "hot-keys", df_schema=True)  # at most `slots` rows
        hot_path = f"{path.rstrip('/')}/hot-{uuid.uuid4().hex[:12]}"
        rows.join(F.broadcast(hot), KEY_HASH, "left_semi").write.parquet(hot_path)
        rows = rows.join(F.broadcast(hot), KEY_HASH, "left_anti")
    writer = rows.repartition(buckets, KEY_HASH).write.mode("overwrite").format("parquet").option("path", f"{path.rstrip('/')}/buckets-{uuid.uuid4().hex[:12]}")
    writer.bucketBy(buckets, KEY_HASH).sortBy(KEY_HASH).saveAsTable(name)
    return Colocated(name, hot_path, tuple(eq_keys), tuple(nullsafe_keys), buckets)


def _same_key(left: DataFrame, right: DataFrame, table: Colocated) -> Column:
    """Equal hashes, and equal keys. The latter are no join keys of their own, which would ask for another partitioning."""
    equal = [F.coalesce(left[k] == right[f"_d_{k}"], F.lit(False)) for k in table.eq_keys]
    equal += [left[k].eqNullSafe(right[f"_d_{k}"]) for k in table.nullsafe_keys]
    return (left[KEY_HASH] == right["_d_hash"]) & F.forall(F.array(*equal), lambda same: same)


def colocated_lookup(spark: SparkSession, fact: Colocated, dim: Colocated, value_cols: list[str]) -> DataFrame:
    """Left join of a fact to a dimension that is unique on its keys, both written by :func:`save_colocated`.

    ``eq_keys`` match with ``=``, ``nullsafe_keys`` with IS NOT DISTINCT FROM.
    """
    if (fact.eq_keys, fact.nullsafe_keys, fact.buckets) != (dim.eq_keys, dim.nullsafe_keys, dim.buckets):
        raise ValueError(f"{fact.name} and {dim.name} are not laid out alike")
    d = dim.cold(spark).select(F.col(KEY_HASH).alias("_d_hash"), *[F.col(f"`{k}`").alias(f"_d_{k}") for k in dim.keys], *value_cols)
    cold = fact.cold(spark)
    names = [c for c in cold.columns if c != KEY_HASH]
    out = cold.join(d, _same_key(cold, d, fact), "left").select(*[cold[c] for c in names], *value_cols)
    hot = fact.hot(spark)
    if hot is None:
        return out
    few = d.join(F.broadcast(hot.select(KEY_HASH).distinct()), F.col("_d_hash") == F.col(KEY_HASH), "left_semi")  # a row per hot key
    return out.unionByName(hot.join(F.broadcast(few), _same_key(hot, few, fact), "left").select(*[hot[c] for c in names], *value_cols))
