"""Cleaning job: the edges beyond the dirty fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from civicspark.operators import cleaning as K
from civicspark.plans.clean import clean_requests
from civicspark.schema import RAW_COLUMNS, VALID_BOROUGHS
from civicspark.sources.fixture import requests_raw, requests_wide
from tests.conftest import SF_SMALL


def _df(spark, data: dict, schema: str | None = None):
    rows = list(zip(*data.values()))
    if schema is None:
        schema = ", ".join(f"{c} string" for c in data)
    return spark.createDataFrame(rows, schema)


# Every cleaning step over the whole dirty fixture is compared with the oracle in
# test_entry.py; here are the edges the fixture does not have.


def test_every_kind_of_dirt_is_in_the_fixture_and_gone_after_cleaning(spark):
    raw = requests_raw(spark, SF_SMALL)
    dirt = {
        "created_date": F.col("created_date") == "invalid",
        "latitude": F.col("latitude").isin("39.9", "n/a"),
        "longitude": F.col("longitude") == "-72.5",
        "borough": F.col("borough").isin("bx", "Kings", "MN", "Richmond", "Unspecified"),
        "complaint_type": F.col("complaint_type").isNull(),
        "incident_zip": F.col("incident_zip").isNull(),
    }
    found = raw.agg(*[F.count_if(cond).alias(c) for c, cond in dirt.items()]).first().asDict()
    assert all(n > 0 for n in found.values()), found
    clean = clean_requests(raw, RAW_COLUMNS)
    left = clean.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in ("latitude", "longitude", "borough", "complaint_type", "incident_zip", "unique_key")],
        F.count_if(~F.col("latitude").between(40, 41) | ~F.col("longitude").between(-75, -73)).alias("range"),
        F.count_if(~F.col("borough").isin(sorted(VALID_BOROUGHS))).alias("domain"),
        (F.count(F.lit(1)) - F.count_distinct("unique_key")).alias("repeats"),
    ).first()
    assert all(v == 0 for v in left), left


def test_borough_is_not_trimmed(spark):
    df = spark.createDataFrame([(" BX",), ("staten island",), ("Richmond",)], "borough string")
    out = sorted(r["borough"] for r in K.standardize_borough(df).collect())
    assert out == ["STATEN ISLAND", "STATEN ISLAND", "UNKNOWN"]


def test_nan_is_a_missing_value(spark):
    nan = float("nan")
    df = spark.createDataFrame([(str(i), x, nan) for i, x in enumerate([1.0, nan, 3.0, None, 5.0])], "unique_key string, x double, void double")
    out = clean_requests(df)
    assert out.columns == ["unique_key", "x"]
    assert [r["x"] for r in out.orderBy("unique_key").collect()] == [1.0, 3.0, 3.0, 3.0, 5.0]


def test_typed_columns_are_not_parsed_again(spark):
    row = (dt.datetime(2024, 5, 6, 7, 8, 9), dt.date(2024, 5, 7), 40.5, float("nan"))
    df = spark.createDataFrame([row], "created_date timestamp_ntz, closed_date date, latitude double, longitude double")
    out = K.parse_coordinates(K.parse_dates(df))
    assert tuple(out.first()) == (row[0], dt.datetime(2024, 5, 7), 40.5, None)
    assert "RLIKE" not in out._jdf.queryExecution().optimizedPlan().toString().upper()


def test_declared_layouts(spark):
    df = _df(spark, {"created_date": ["07/04/2023 12:05:06 AM", "2023-07-04T01:02:03+02:00", "2023-07-04", "07-04-2023"], "closed_date": [None] * 4})
    out = K.parse_dates(df, ("iso", "MM/dd/yyyy hh:mm:ss a", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    assert [r["created_date"] for r in out.collect()] == [
        dt.datetime(2023, 7, 4, 0, 5, 6), dt.datetime(2023, 7, 3, 23, 2, 3), dt.datetime(2023, 7, 4), None,
    ]
    assert [r["created_date"] for r in K.parse_dates(df).collect()] == [None, None, dt.datetime(2023, 7, 4), None]


def test_empty_columns_leave_without_a_second_stage(spark, monkeypatch):
    from civicspark.plans import clean as plan

    written = []
    real = plan.scratch_path
    monkeypatch.setattr(plan, "scratch_path", lambda s, name: written.append(name) or real(s, name))
    raw = requests_wide(spark, SF_SMALL)
    assert set(plan.clean_requests(raw).columns) & {"empty_text", "nan_number"} == set()
    assert written.count("clean-stage") == 1
    # A date column without values changes the typing steps: staged again without it.
    no_dates = raw.withColumn("closed_date", F.lit(None).cast("string"))
    assert "response_time_hours" not in plan.clean_requests(no_dates).columns
    assert written.count("clean-stage") == 3


def test_null_keys_dropped_before_statistics(spark):
    # The null-key row's latitude (40.9) must not weigh in the median.
    df = spark.createDataFrame(
        [("1", "40.1", "-74.0"), ("2", None, "-74.0"), ("3", "40.3", "-74.0"), (None, "40.9", "-74.0")],
        "unique_key string, latitude string, longitude string",
    )
    out = {r["unique_key"]: r["latitude"] for r in clean_requests(df).collect()}
    assert set(out) == {"1", "2", "3"}
    assert out["2"] == pytest.approx(40.2)


def test_other_string_columns_take_the_mode(spark):
    df = spark.createDataFrame(
        [("1", "10002"), ("2", "10001"), ("3", "10002"), ("4", "10001"), ("5", None)],
        "unique_key string, incident_zip string",
    )
    out = {r["unique_key"]: r["incident_zip"] for r in clean_requests(df).collect()}
    assert out["5"] == "10001"  # tie -> smallest value


def test_closed_before_created_is_nulled_equal_is_kept(spark):
    df = _df(spark, {
        "unique_key": ["a", "b", "c"],
        "created_date": ["2024-01-02T00:00:00", "2024-01-02T00:00:00", None],
        "closed_date": ["2024-01-01T00:00:00", "2024-01-02T00:00:00", "2024-01-03T00:00:00"],
    })
    out = {r["unique_key"]: r["closed_date"] for r in K.repair_dates(K.parse_dates(df)).collect()}
    assert out["a"] is None
    assert out["b"] == dt.datetime(2024, 1, 2)
    assert out["c"] == dt.datetime(2024, 1, 3)  # a null creation time never nulls closed_date


def test_parsers_reject_loose_text(spark):
    df = _df(spark, {
        "created_date": ["2025", "2024-13-01T00:00:00", "2024-01-01 10:00:00", "2024-01-01"],
        "closed_date": [None, None, None, None],
        "latitude": ["1.0d", "nan", " 40.5 ", "4e1"],
        "longitude": ["-74", "-74", "-74", "-74"],
    })
    rows = K.parse_coordinates(K.parse_dates(df)).collect()
    assert [r["created_date"] for r in rows] == [None, None, dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1)]
    assert [r["latitude"] for r in rows] == [None, None, 40.5, 40.0]


def test_response_time_median_can_be_left_out(spark):
    df = _df(spark, {
        "unique_key": ["1", "2", "3"],
        "created_date": ["2024-01-01T00:00:00"] * 3,
        "closed_date": ["2024-01-01T01:00:00", "2024-01-01T03:00:00", None],
    })
    filled = {r["unique_key"]: r["response_time_hours"] for r in clean_requests(df).collect()}
    assert filled["3"] == pytest.approx(2.0)
    kept = {r["unique_key"]: r["response_time_hours"] for r in clean_requests(df, impute_response_time=False).collect()}
    assert kept["3"] is None


def test_no_rows_loses_every_column(spark):
    df = spark.createDataFrame([], "unique_key string, borough string")
    assert clean_requests(df).columns == []


def test_column_names_normalised_after_selection(spark):
    df = spark.createDataFrame([("1", "Noise")], "`Unique Key` string, ` Complaint Type ` string")
    out = clean_requests(df, required_columns=["Unique Key", " Complaint Type "])
    assert out.columns == ["unique_key", "complaint_type"]


def test_times_do_not_depend_on_the_session_zone(spark):
    # 1995-10-15 00:00 does not exist in America/Sao_Paulo (clocks jumped to 01:00).
    df = _df(spark, {
        "unique_key": ["1"],
        "created_date": ["1995-10-15T00:00:00"],
        "closed_date": ["1995-10-16T00:00:00"],
    })
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        row = K.add_response_time(K.parse_dates(df)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["created_date"] == dt.datetime(1995, 10, 15)
    assert row["response_time_hours"] == 24.0


def test_second_coordinate_pair_and_other_categoricals(spark):
    df = spark.createDataFrame(
        [("1", "40.5", "-74.0", None, "Brooklyn"), ("2", "45.0", "-74.2", "Open", None), ("3", "40.7", "-80", "Open", None)],
        "unique_key string, incident_address_latitude string, incident_address_longitude string, "
        "status string, city string",
    )
    out = {r["unique_key"]: r for r in clean_requests(df).collect()}
    assert out["1"]["status"] == "UNKNOWN" and out["2"]["city"] == "UNKNOWN"
    assert out["2"]["incident_address_latitude"] == pytest.approx(40.6)  # 45.0 out of range -> median
    assert out["3"]["incident_address_longitude"] == pytest.approx(-74.1)


def test_half_a_coordinate_pair_is_left_as_text(spark):
    df = spark.createDataFrame([("1", "40.5"), ("2", None)], "unique_key string, latitude string")
    out = clean_requests(df)
    assert dict(out.dtypes)["latitude"] == "string"
    # a text column outside the categorical list takes the mode
    assert {r["unique_key"]: r["latitude"] for r in out.collect()} == {"1": "40.5", "2": "40.5"}
