"""Co-located tables, pruned rank reads and date layouts found in the data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from civicspark.operators import cleaning as K
from civicspark.operators import stats
from civicspark.operators.colocated import KEY_HASH, colocated_lookup, save_colocated
from civicspark.plans.clean import clean_requests
from civicspark.schema import RAW_COLUMNS

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tables(spark):
    rnd = random.Random(4)
    keys = [(f"b{i % 7}" if i % 11 else None, i % 13, i / 4 if i % 5 else None) for i in range(60)]
    keys = list(dict.fromkeys(keys))
    facts = [(n, *(keys[0] if n % 3 == 0 else rnd.choice(keys))) for n in range(2000)] + [(9999, "nowhere", 1, None)]
    fact = spark.createDataFrame(facts, "id int, a string, b int, c double")
    dim = spark.createDataFrame([(*k, n) for n, k in enumerate(keys)], "a string, b int, c double, place int")
    return fact, dim, facts, {k: n for n, k in enumerate(keys)}


def _names(plan):
    return plan.toString()


def test_lookup_between_buckets_moves_no_rows(spark, tmp_dir, no_broadcast):
    fact, dim, facts, places = _tables(spark)
    f = save_colocated(fact, "facts_by_key_of_test", f"{tmp_dir}/f", ("a", "b"), ("c",), buckets=4, hot_slots=5)
    d = save_colocated(dim, "places_by_key_of_test", f"{tmp_dir}/d", ("a", "b"), ("c",), buckets=4, unique=True)
    assert 600 <= f.hot(spark).count() < 1500 and f.rows(spark).count() == len(facts)
    out = colocated_lookup(spark, f, d, ["place"])
    want = {n: places.get((a, b, c)) if a is not None else None for n, a, b, c in facts}
    assert {r["id"]: r["place"] for r in out.collect()} == want and out.columns == ["id", "a", "b", "c", "place"]

    cold = colocated_lookup(spark, f.__class__(f.name, None, f.eq_keys, f.nullsafe_keys, f.buckets), d, ["place"])
    plan = _names(cold._jdf.queryExecution().executedPlan())
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert cold.count() == f.cold(spark).count()
    for name in (f.name, d.name):
        spark.sql(f"DROP TABLE {name}")


def test_layouts_that_differ_are_refused(spark, tmp_dir):
    fact, dim, _, _ = _tables(spark)
    f = save_colocated(fact, "facts_two_of_test", f"{tmp_dir}/f", ("a",), buckets=4)
    d = save_colocated(dim.dropDuplicates(["a"]), "places_two_of_test", f"{tmp_dir}/d", ("a",), buckets=2, unique=True)
    with pytest.raises(ValueError, match="not laid out alike"):
        colocated_lookup(spark, f, d, ["place"])
    with pytest.raises(ValueError, match="Invalid table name"):
        save_colocated(fact, "no name", tmp_dir, ("a",))
    for name in (f.name, d.name):
        spark.sql(f"DROP TABLE {name}")


def test_equal_hashes_of_different_keys(spark, tmp_dir, monkeypatch):
    """The keys themselves decide, should two of them share a hash."""
    from civicspark.operators import colocated

    monkeypatch.setattr(colocated, "key_hash", lambda keys: F.lit(1).cast("bigint"))
    fact, dim, facts, places = _tables(spark)
    f = save_colocated(fact, "facts_three_of_test", f"{tmp_dir}/f", ("a", "b"), ("c",), buckets=2, hot_slots=1)
    d = save_colocated(dim, "places_three_of_test", f"{tmp_dir}/d", ("a", "b"), ("c",), buckets=2, unique=True)
    got = {r["id"]: r["place"] for r in colocated_lookup(spark, f, d, ["place"]).collect()}
    assert got == {n: places.get((a, b, c)) if a is not None else None for n, a, b, c in facts}
    assert KEY_HASH not in f.rows(spark).columns
    for name in (f.name, d.name):
        spark.sql(f"DROP TABLE {name}")


def test_a_median_reads_the_files_of_its_middle_parts(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("x"), (F.col("id") % 4000).cast("double").alias("y"))
    table = stats.median_table(df, ["x", "y"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    got = {r["column_name"]: r["median"] for r in table.collect()}
    xs = sorted(k * 7919 % 20_011 for k in range(20_000))
    assert got == {"x": (xs[9999] + xs[10_000]) / 2, "y": 1999.5}

    def leaves(p):
        if p.nodeName() == "AdaptiveSparkPlan":
            return leaves(p.executedPlan())
        if "QueryStage" in p.nodeName():
            return leaves(p.plan())
        kids = p.children()
        return [p] if kids.size() == 0 else [x for k in range(kids.size()) for x in leaves(kids.apply(k))]

    read = [leaf for leaf in leaves(table._jdf.queryExecution().executedPlan()) if leaf.nodeName().startswith("Scan parquet")]
    values = [leaf for leaf in read if "v" in [leaf.output().apply(k).name() for k in range(leaf.output().size())]]
    assert len(values) == 1 and values[0].metrics().apply("numFiles").value() <= 4


#: texts, candidates, the layout found, how many texts it reads
COLUMNS = [
    (["2024-01-02", "2024-01-02T03:04:05", "01/02/2024"], ("iso", "MM/dd/yyyy"), "iso", 2),
    (["01/13/2024", "01/14/2024", "2024-01-02", None, "x"], ("iso", "MM/dd/yyyy"), "MM/dd/yyyy", 2),
    (["01/02/2024", "2024-01-02"], ("iso", "MM/dd/yyyy"), "iso", 1),
    (["01/02/2024", "2024-01-02"], ("MM/dd/yyyy", "iso"), "MM/dd/yyyy", 1),
    (["13/01/2024", "14/01/2024", "02/03/2024"], ("MM/dd/yyyy", "dd/MM/yyyy"), "dd/MM/yyyy", 3),
    (["nothing", None], ("iso", "MM/dd/yyyy"), None, 0),
]


@pytest.mark.parametrize(("texts", "candidates", "layout", "n"), COLUMNS)
def test_the_layout_with_most_votes_is_read(spark, texts, candidates, layout, n):
    df = spark.createDataFrame([(t, dt.datetime(2024, 1, 1)) for t in texts], "created_date string, closed_date timestamp_ntz")
    assert K.infer_layouts(df, candidates) == ({"created_date": layout} if layout else {})
    parsed = K.parse_dates_inferred(df, candidates)
    assert parsed.where("created_date IS NOT NULL").count() == n and parsed.where("closed_date IS NULL").count() == 0


def test_no_candidates_and_no_date_columns(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert K.infer_layouts(df, ("iso",)) == {} and K.parse_dates_inferred(df).columns == ["x"]
    with pytest.raises(ValueError, match="no layouts"):
        K.infer_layouts(df, ())


def test_cleaning_with_found_layouts(spark):
    rows = [(str(i), "Noise", "BX", f"0{i % 3 + 1}/1{i % 9}/2024 0{i % 9 + 1}:30:00 PM", f"2024-04-0{i % 9 + 1}T10:00:00Z", "A", "d", "1", "40.5", "-73.9") for i in range(12)]
    rows.append(("99", "Noise", "BX", "2024-01-01T00:00:00", "2024-01-02", "A", "d", "1", "40.5", "-73.9"))
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["unique_key", "complaint_type", "borough", "created_date", "closed_date", "agency", "descriptor", "incident_zip", "latitude", "longitude"]))
    from civicspark.functions.columns import KNOWN_LAYOUTS

    clean = {r["unique_key"]: r for r in clean_requests(raw, RAW_COLUMNS, layouts=KNOWN_LAYOUTS, inferred=True).collect()}
    assert clean["0"]["created_date"] == dt.datetime(2024, 1, 10, 13, 30) and clean["0"]["closed_date"] == dt.datetime(2024, 4, 1, 10)
    assert clean["99"]["created_date"] is None and clean["99"]["closed_date"] is None
