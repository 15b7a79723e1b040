"""Sources and sinks."""

import os

import pytest

from civicspark.schema import RAW_SCHEMA
from civicspark.sinks.files import save_parquet, save_raw, save_table
from civicspark.sources import paging
from civicspark.sources.files import load_file, read_dataset, read_pages


@pytest.fixture
def small(spark):
    return spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a long, b string")


def test_parquet_round_trip(spark, small, tmp_dir):
    p = os.path.join(tmp_dir, "t.parquet")
    save_raw(small, p)
    assert sorted(tuple(r) for r in load_file(spark, p).collect()) == [(1, "x"), (2, "y"), (3, "z")]


def test_csv_round_trip_keeps_text(spark, tmp_dir):
    df = spark.createDataFrame([("00501", 'say "hi", ok'), ("10001", None)], "zip string, note string")
    p = os.path.join(tmp_dir, "t.csv")
    save_raw(df, p)
    got = {r["zip"]: r["note"] for r in load_file(spark, p).collect()}
    assert got == {"00501": 'say "hi", ok', "10001": None}  # leading zero kept: no type inference


def test_unsupported_extension(spark, small, tmp_dir):
    with pytest.raises(ValueError, match="Unsupported file format"):
        save_raw(small, os.path.join(tmp_dir, "t.json"))
    with pytest.raises(ValueError, match="Unsupported file format"):
        load_file(spark, os.path.join(tmp_dir, "t.txt"))


def test_missing_file(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        load_file(spark, os.path.join(tmp_dir, "missing.parquet"))


def test_parquet_overwrite_and_empty_keeps_schema(spark, small, tmp_dir):
    p = os.path.join(tmp_dir, "clean")
    save_parquet(small, p)
    save_parquet(small.limit(0), p)
    back = spark.read.parquet(p)
    assert back.count() == 0 and back.columns == ["a", "b"]


def test_table_overwrite_schema_swap_and_bad_name(spark, small, tmp_dir):
    save_table(small, "t_small", os.path.join(tmp_dir, "t1"))
    assert spark.table("t_small").count() == 3
    other = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], "x long, y long, z long")
    save_table(other, "t_small", os.path.join(tmp_dir, "t2"))
    assert spark.table("t_small").columns == ["x", "y", "z"] and spark.table("t_small").count() == 2
    save_table(small.limit(0), "t_empty", os.path.join(tmp_dir, "t3"))
    assert spark.table("t_empty").columns == ["a", "b"]
    with pytest.raises(ValueError, match="Invalid table name"):
        save_table(small, "bad-name; drop", os.path.join(tmp_dir, "t4"))


def test_pages_with_missing_keys_and_arrays(spark, tmp_dir):
    p = os.path.join(tmp_dir, "pages")
    os.makedirs(p)
    with open(os.path.join(p, "page-0.json"), "w") as f:
        f.write('[{"unique_key": "1", "complaint_type": "Noise"}, {"unique_key": "2"}]\n')
    with open(os.path.join(p, "page-1.json"), "w") as f:
        f.write('{"unique_key": "3", "borough": "BX", "extra": 1}\n')
    df = read_pages(spark, p)
    assert df.columns == RAW_SCHEMA.fieldNames()
    got = {r["unique_key"]: (r["complaint_type"], r["borough"]) for r in df.collect()}
    assert got == {"1": ("Noise", None), "2": (None, None), "3": (None, "BX")}


def test_hive_layout_and_nested_plain_dirs(spark, small, tmp_dir):
    p = os.path.join(tmp_dir, "hive")
    small.write.partitionBy("b").parquet(p)
    df = read_dataset(spark, p)
    assert sorted(df.columns) == ["a", "b"] and df.count() == 3
    q = os.path.join(tmp_dir, "nested")
    small.write.parquet(os.path.join(q, "x", "y"))
    small.write.parquet(os.path.join(q, "z"))
    assert read_dataset(spark, q).count() == 6


def test_every_layout_below_a_folder_is_read(spark, small, tmp_dir):
    p = os.path.join(tmp_dir, "mixed")
    small.write.parquet(p)
    small.write.parquet(os.path.join(p, "plain", "deep"))
    small.withColumn("c d", small.a + 10).write.mode("append").partitionBy("b").parquet(p)
    with open(os.path.join(p, "readme.txt"), "w") as f:
        f.write("not a table")
    df = read_dataset(spark, p)
    assert df.count() == 9 and sorted(df.columns) == ["a", "b", "c d"]
    assert sorted((r["a"], r["b"]) for r in df.collect()) == sorted([(1, "x"), (2, "y"), (3, "z")] * 3)
    spaced = os.path.join(tmp_dir, "with space")
    small.withColumnRenamed("b", "k").replace({"x": "a b", "y": "50%"}).write.partitionBy("k").parquet(spaced)
    assert sorted(r["k"] for r in read_dataset(spark, spaced).collect()) == ["50%", "a b", "z"]


def test_layouts_that_do_not_combine_and_empty_folders_are_errors(spark, small, tmp_dir):
    p = os.path.join(tmp_dir, "clash")
    small.write.parquet(p)
    small.selectExpr("cast(a as string) a", "b").write.mode("append").partitionBy("b").parquet(p)
    with pytest.raises(ValueError, match="different types"):
        read_dataset(spark, p)
    q = os.path.join(tmp_dir, "void")
    os.makedirs(q)
    with pytest.raises(FileNotFoundError):
        read_dataset(spark, q)


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    df = spark.createDataFrame([("2024-01-01T00:00:00", "42", "NYPD", "x")], "created_date string, unique_key string, agency string, other string")
    p = os.path.join(tmp_dir, "swapped.csv")
    save_raw(df, p)
    back = load_file(spark, p, RAW_SCHEMA)
    row = back.first()
    assert back.columns == RAW_SCHEMA.fieldNames()
    assert (row["unique_key"], row["created_date"], row["agency"], row["complaint_type"]) == ("42", "2024-01-01T00:00:00", "NYPD", None)
    save_raw(df.select("agency", "unique_key"), os.path.join(tmp_dir, "other.csv"))
    part = next(f for f in os.listdir(os.path.join(tmp_dir, "other.csv")) if f.endswith(".csv"))
    os.link(os.path.join(tmp_dir, "other.csv", part), os.path.join(p, "zz.csv"))
    with pytest.raises(Exception, match="CSV header|header"):
        load_file(spark, p, RAW_SCHEMA).collect()


def test_csv_line_ends_inside_a_field(spark, tmp_dir):
    df = spark.createDataFrame([("1", "two\nlines"), ("2", "one")], "unique_key string, descriptor string")
    p = os.path.join(tmp_dir, "lines.csv")
    save_raw(df, p)
    got = {r["unique_key"]: r["descriptor"] for r in load_file(spark, p, df.schema, multi_line=True).collect()}
    assert got == {"1": "two\nlines", "2": "one"}


def test_date_range_reaches_the_scan(spark, tmp_dir):
    p = os.path.join(tmp_dir, "requests.parquet")
    _requests(spark).write.parquet(p)
    plan = paging.created_between(spark.read.parquet(p), "2024-01-03", "2024-01-04")
    assert sorted(r["unique_key"] for r in plan.collect()) == ["3", "4"]
    pushed = plan._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(created_date," in pushed and "LessThan(created_date,2024-01-05)" in pushed


def _requests(spark):
    rows = [(str(i), f"2024-01-{i:02d}T00:00:00") for i in range(1, 11)]
    return spark.createDataFrame(rows, "unique_key string, created_date string")


def test_total_limit_over_pages(spark):
    # a limit of 7 over pages of 5: the 7 newest rows
    df = _requests(spark)
    keys = {r["unique_key"] for r in paging.take_newest(df, 7).collect()}
    assert keys == {str(i) for i in range(10, 3, -1)}
    assert "TakeOrdered" not in paging.take_newest(df, 7)._jdf.queryExecution().executedPlan().toString()
    pages = [paging.page_slice(df, off, 5) for off in (0, 5)]
    both = [r["unique_key"] for p in pages for r in p.collect()]
    assert both == [str(i) for i in range(10, 0, -1)]


def test_batch_size_bounds(spark):
    with pytest.raises(ValueError, match="batch_size"):
        paging.check_batch_size(0)
    with pytest.raises(ValueError, match="batch_size"):
        paging.check_batch_size(1001)
    assert paging.check_batch_size(1000) == 1000


def test_date_range_is_inclusive(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01T00:00:00"), ("b", "2024-01-31T23:59:59"), ("c", "2024-02-01T00:00:00"), ("d", "bad")],
        "unique_key string, created_date string",
    )
    got = sorted(r["unique_key"] for r in paging.created_between(df, "2024-01-01", "2024-01-31").collect())
    assert got == ["a", "b"]
    assert paging.created_between(df).count() == 4


def test_pretty_printed_pages(spark, tmp_dir):
    p = os.path.join(tmp_dir, "pretty")
    os.makedirs(p)
    with open(os.path.join(p, "page.json"), "w") as f:
        f.write('[\n  {"unique_key": "1",\n   "agency": "NYPD"},\n  {"unique_key": "2"}\n]\n')
    got = {r["unique_key"]: r["agency"] for r in read_pages(spark, p, multi_line=True).collect()}
    assert got == {"1": "NYPD", "2": None}


def test_pages_stop_at_limit_and_short_pages(spark):
    df = _requests(spark)  # 10 rows
    sizes = [p.count() for p in paging.pages(df, 5, total_limit=7)]
    assert sizes == [5, 2]
    keys = [r["unique_key"] for p in paging.pages(df, 5, total_limit=7) for r in p.collect()]
    assert keys == [str(i) for i in range(10, 3, -1)]
    assert [p.count() for p in paging.pages(df, 4)] == [4, 4, 2]  # short page ends the read
    assert [p.count() for p in paging.pages(df, 5)] == [5, 5]
    assert list(paging.pages(df.limit(0), 5)) == [] and list(paging.pages(df, 5, total_limit=0)) == []


def test_repeated_rows_have_places_of_their_own(spark):
    df = _requests(spark)
    df = df.unionByName(df).unionByName(df)
    got = [r["unique_key"] for p in paging.pages(df, 7) for r in p.collect()]
    assert got == [str(i) for i in range(10, 0, -1) for _ in range(3)]
