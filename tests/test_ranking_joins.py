"""Surrogate keys and lookups: the scale paths against the simple ones."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicspark.operators.joins import lookup
from civicspark.operators.ranking import dense_rank_ids


def _locations(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = {
        (rnd.choice(["BRONX", "QUEENS", None]), rnd.choice(["10001", "10002", None]),
         rnd.choice([None, round(rnd.uniform(40, 41), 3)]), rnd.choice([None, round(rnd.uniform(-75, -73), 3)]))
        for _ in range(n)
    }
    return spark.createDataFrame(sorted(rows, key=str), "borough string, zip string, lat double, lon double")


def test_range_ranked_ids_equal_dense_rank(spark):
    df = _locations(spark)
    cols = ["borough", "zip", "lat", "lon"]
    ours = dense_rank_ids(df, cols, "id", num_partitions=5)
    ref = df.withColumn("ref", F.dense_rank().over(Window.orderBy(*[F.col(c).asc_nulls_last() for c in cols])))
    joined = ours.join(ref, [ours[c].eqNullSafe(ref[c]) for c in cols])
    assert joined.count() == df.count()
    assert joined.where(F.col("id") != F.col("ref")).count() == 0
    assert ours.columns[0] == "id" and dict(ours.dtypes)["id"] == "bigint"


def test_ids_are_dense_whatever_the_partitions(spark):
    df = _locations(spark, n=500, seed=9)
    cols = ["borough", "zip", "lat", "lon"]
    a, b = ({tuple(r[c] for c in cols): r["id"] for r in dense_rank_ids(df, cols, "id", n).collect()} for n in (1, 7))
    assert a == b and sorted(a.values()) == list(range(1, len(a) + 1))
    assert dense_rank_ids(df.limit(0), cols, "id").count() == 0


def _facts(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(4000):
        hot = i % 3 == 0  # a third of the rows share one key
        rows.append((i, "BRONX" if hot else rnd.choice(["QUEENS", None, "BRONX"]),
                     "10001" if hot else rnd.choice(["10001", "10002"]),
                     40.5 if hot else rnd.choice([None, 40.25, 40.75]),
                     -74.0 if hot else rnd.choice([None, -74.5])))
    return spark.createDataFrame(rows, "i long, borough string, zip string, lat double, lon double")


def _dim(spark, facts):
    cols = ["borough", "zip", "lat", "lon"]
    return dense_rank_ids(facts.select(*cols).distinct(), cols, "location_id")


def test_lookup_split_path_equals_broadcast_path(spark):
    facts = _facts(spark)
    dim = _dim(spark, facts)
    keys = (["borough", "zip"], ["lat", "lon"], ["location_id"])
    plain = {r["i"]: r["location_id"] for r in lookup(facts, dim, *keys).collect()}
    split = {r["i"]: r["location_id"] for r in lookup(facts, dim, *keys, broadcast_rows=0, hot_slots=10).collect()}
    assert plain == split and len(plain) == 4000
    # plain '=' on borough and zip: a null borough never finds a key.
    nulls = facts.where("borough is null").select("i").collect()
    assert nulls and all(plain[r["i"]] is None for r in nulls)
    # IS NOT DISTINCT FROM on coordinates: a null latitude still matches.
    some = facts.where("borough is not null and lat is null").select("i").collect()
    assert some and all(plain[r["i"]] is not None for r in some)
