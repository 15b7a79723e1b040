"""Dimensions from one scan and reports from one pass: the same tables as one by one, with the plans they are for."""

import os

import pytest
from pyspark.sql import functions as F

from civicspark import queries as Q
from civicspark.operators import reports as R
from civicspark.operators import star as S
from civicspark.plans.reports import generate_reports, reports_in_one_pass
from civicspark.plans.star import build_star_schema
from civicspark.sinks.files import plain_number, write_report_csv
from civicspark.sources.files import load_file, read_star
from tests.conftest import SF_SMALL

CLEAN = "unique_key string, created_date timestamp_ntz, closed_date timestamp_ntz, complaint_type string, agency string, borough string, descriptor string, incident_zip string, latitude double, longitude double, response_time_hours double"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _scans(df, table):
    return df._jdf.queryExecution().optimizedPlan().toString().count(f"{table}.parquet") or sum(
        1 for k in _leaves(df) if table in k.simpleString(10_000)
    )


def _leaves(df):
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return [leaves.apply(k) for k in range(leaves.size())]


def _odd(spark):
    from datetime import datetime as D

    rows = [
        ("1", D(2024, 2, 29, 1), None, "Noise", "NYPD", "BRONX", None, "10451", 40.5, None, 1.5),
        ("2", None, None, "", "", None, "d", None, None, None, None),
        ("3", D(2024, 2, 29, 23), None, "Noise", None, "BRONX", "x", "10451", 40.5, -73.5, -1.0),
        ("4", D(2023, 1, 1), None, None, "DOT", "BRONX", "x", "10451", 40.5, -73.5, 2e7),
    ]
    return spark.createDataFrame(rows, CLEAN)


@pytest.mark.parametrize("partitions", [None, "1", "37"])
def test_dimensions_are_those_built_one_by_one(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for clean in (Q._clean(spark, SF_SMALL), _odd(spark), _odd(spark).limit(0), _odd(spark).where("unique_key = '2'")):
            found = S.dimensions_in_one_scan(clean)
            for name, df in found.items():
                want = getattr(S, name)(clean)
                assert df.dtypes == want.dtypes and _rows(df) == _rows(want), name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_star_build_in_few_jobs(spark, tmp_dir):
    clean_dir = Q._clean_dir(spark, SF_SMALL)
    sc = spark.sparkContext
    sc.setJobGroup("one-pass-star", "star")
    counts = build_star_schema(spark, clean_dir, f"{tmp_dir}/star")
    assert len(sc.statusTracker().getJobIdsForGroup("one-pass-star")) <= 15
    sc.setJobGroup("one-pass-reports", "reports")
    generate_reports(spark, f"{tmp_dir}/star", f"{tmp_dir}/reports")
    assert len(sc.statusTracker().getJobIdsForGroup("one-pass-reports")) <= 8
    sc.setLocalProperty("spark.jobGroup.id", None)
    star = read_star(spark, f"{tmp_dir}/star")
    assert {t: df.count() for t, df in star.items()} == counts


def test_reports_are_those_made_one_by_one(spark):
    star = Q._stars(spark, SF_SMALL)
    for tables in (star, {t: df.limit(0) for t, df in star.items()}):
        together, single = reports_in_one_pass(tables), R.all_reports(tables)
        assert list(together) == R.REPORT_NAMES
        for name, df in together.items():
            assert df.columns == single[name].columns
            assert [tuple(r) for r in df.collect()] == [tuple(r) for r in single[name].collect()], name


def test_facts_without_keys_and_crowded_tops(spark):
    facts = [(f"{k}", None, None, 0.5 if k % 3 else None, k % 40 if k % 11 else None, (k % 90) if k % 7 else None, k % 5 if k % 13 else None) for k in range(20_000)]
    fact = spark.createDataFrame(facts, "unique_key string, created_date timestamp_ntz, closed_date timestamp_ntz, response_time_hours double, agency_id bigint, complaint_id bigint, location_id bigint")
    star = {
        "fact_311_requests": fact,
        "dim_agency": spark.createDataFrame([(k, f"a{k:02d}") for k in range(38)], "agency_id bigint, agency string"),
        "dim_complaint": spark.createDataFrame([(k, f"t{k % 30:02d}" if k % 30 else None) for k in range(90)], "complaint_id bigint, complaint_type string"),
        "dim_location": spark.createDataFrame([(k, ["BRONX", "QUEENS", None][k % 3]) for k in range(5)], "location_id bigint, borough string"),
        "dim_date": spark.createDataFrame([], "date date"),
    }
    star["dim_agency"] = star["dim_agency"].where("agency_id <> 3")  # a key that leads nowhere
    together, single = reports_in_one_pass(star), R.all_reports(star)
    for name in R.REPORT_NAMES:
        assert [tuple(r) for r in together[name].collect()] == [tuple(r) for r in single[name].collect()], name


def test_one_scan_of_the_fact(spark):
    star = Q._stars(spark, SF_SMALL)
    scans = [leaf for leaf in _leaves(R.fact_sums(star["fact_311_requests"])) if "Relation" in leaf.nodeName()]
    assert len(scans) == 1
    plan = R.fact_sums(star["fact_311_requests"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and "unique_key" not in plan


def test_report_files(spark, tmp_dir):
    df = spark.createDataFrame([('a "b", c', 1e7, 3), (None, 0.25, 4), ("", 12.5, 5), ("x", -1e-3, 6)], "name string, hours double, n bigint")
    path = os.path.join(tmp_dir, "deep", "r.csv")
    write_report_csv(df.orderBy("n"), path)
    with open(path, encoding="utf-8") as f:
        assert f.read() == 'name,hours,n\n"a ""b"", c",10000000.0,3\n,0.25,4\n,12.5,5\nx,-0.001,6\n'
    assert [x for x in os.listdir(os.path.dirname(path)) if not x.endswith(".crc")] == ["r.csv"]
    write_report_csv(df.limit(0), path)  # replaces the file
    with open(path, encoding="utf-8") as f:
        assert f.read() == "name,hours,n\n"
    os.makedirs(f"{tmp_dir}/old.csv/part")
    write_report_csv(df.where("n = 4"), f"{tmp_dir}/old.csv")
    assert load_file(spark, f"{tmp_dir}/old.csv").collect() == [(None, "0.25", "4")]


def test_plain_numbers(spark):
    values = [0.0, 1.0, 1e7, 123456789.25, 1e15, -2.5e8, 1e-4, 0.1, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(plain_number(F.col("x"))).collect()] == [
        "0.0", "1.0", "10000000.0", "123456789.25", "1000000000000000.0", "-250000000.0", "0.0001", "0.1", "Infinity", None,
    ]
