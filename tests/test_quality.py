"""Quality checks as tables of cases: input rows, the check, the result row it must give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from civicspark.operators import quality as V
from civicspark.operators.quality import ValidationError, raise_first_failure, validate

T0 = dt.datetime(2021, 6, 1, 8)
SCHEMA = (
    "unique_key string, created_date timestamp_ntz, closed_date timestamp_ntz, complaint_type string, agency string, "
    "borough string, descriptor string, incident_zip string, latitude double, longitude double"
)
BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "UNKNOWN"]


def _sound(n=30):
    """Rows that nothing is wrong with."""
    return [
        {
            "unique_key": f"K{i}", "created_date": T0 + dt.timedelta(hours=i), "closed_date": T0 + dt.timedelta(hours=2 * i) if i % 4 else None,
            "complaint_type": f"type {i % 5}", "agency": f"desk {i % 3}", "borough": BOROUGHS[i % 6], "descriptor": None,
            "incident_zip": "10001", "latitude": 40.2, "longitude": -74.1,
        }
        for i in range(n)
    ]


def _frame(spark, rows, without=()):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    return df.drop(*without)


def _spoiled(column, values, n=30):
    """Sound rows with other values in the first places of a column."""
    rows = _sound(n)
    for row, v in zip(rows, values, strict=False):
        row[column] = v
    return rows


#: check, rows, expected (subject, observed, threshold, passed) rows
CASES = {
    "enough rows": (V.check_row_count, _sound(3), [(None, 3.0, 1.0, True)]),
    "no rows": (V.check_row_count, [], [(None, 0.0, 1.0, False)]),
    "keys differ": (V.check_unique_key, _sound(), [("unique_key", 0.0, 0.0, True)]),
    "one key three times": (V.check_unique_key, _spoiled("unique_key", ["K9", "K9"]), [("unique_key", 2.0, 0.0, False)]),
    "null keys are one value": (V.check_unique_key, _spoiled("unique_key", [None] * 4), [("unique_key", 3.0, 0.0, False)]),
    "times in order": (V.check_date_logic, _sound(), [("closed_date", 0.0, 0.0, True)]),
    "two closed too early": (V.check_date_logic, _spoiled("closed_date", [T0 - dt.timedelta(seconds=1), None, T0]), [("closed_date", 2.0, 0.0, False)]),
    "closed without a beginning": (V.check_date_logic, _spoiled("created_date", [None] * 30), [("closed_date", 0.0, 0.0, True)]),
    "known boroughs": (V.check_borough_values, _sound(), [("borough", 0.0, 0.0, True)]),
    "null is no unknown borough": (V.check_borough_values, _spoiled("borough", [None] * 5), [("borough", 0.0, 0.0, True)]),
    "three strange boroughs": (V.check_borough_values, _spoiled("borough", ["Atlantis", "bronx", ""]), [("borough", 3.0, 0.0, False)]),
}


@pytest.mark.parametrize("case", CASES)
def test_result_rows(spark, case):
    check, rows, want = CASES[case]
    got = check(_frame(spark, rows)).collect()
    assert [(r["subject"], r["observed"], r["threshold"], r["passed"]) for r in got] == want


#: column, its limit, how many nulls in 40 rows pass, how many do not
LIMITS = [("unique_key", 0.0, 0, 1), ("created_date", 0.0, 0, 1), ("complaint_type", 0.05, 2, 3), ("agency", 0.05, 2, 3), ("borough", 0.10, 4, 5)]


@pytest.mark.parametrize(("column", "limit", "fits", "exceeds"), LIMITS)
def test_null_rates_may_reach_their_limit(spark, column, limit, fits, exceeds):
    for n, passed in ((fits, True), (exceeds, False)):
        rows = V.check_null_rates(_frame(spark, _spoiled(column, [None] * n, 40))).collect()
        found = {r["subject"]: r for r in rows}
        assert found[column]["observed"] == pytest.approx(n / 40) and found[column]["threshold"] == limit and found[column]["passed"] is passed
        assert all(r["passed"] for s, r in found.items() if s != column)


def test_missing_numbers_have_two_forms(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    row = V.check_null_rates(df, {"x": 0.4}).first()
    assert row["observed"] == 0.5 and not row["passed"]


def test_columns_that_are_not_there(spark):
    df = _frame(spark, _sound(2), ["latitude", "agency"])
    rows = {r["subject"]: (r["observed"], r["passed"]) for r in V.check_required_columns(df).collect()}
    assert {s for s, (n, ok) in rows.items() if not ok and n == 0.0} == {"latitude", "agency"} and len(rows) == 10
    key = V.check_unique_key(df, key="no such column").first()
    assert key["observed"] is None and not key["passed"]


def test_strange_boroughs_are_listed_with_their_rows(spark):
    values = [f"place {i % 25}" for i in range(60)] + ["BRONX", None]
    found = {r["borough"]: r["n_rows"] for r in V.unexpected_boroughs(spark.createDataFrame([(v,) for v in values], "borough string")).collect()}
    assert found == {f"place {i}": 3 if i < 10 else 2 for i in range(25)}
    assert V.unexpected_boroughs(_frame(spark, _sound())).count() == 0


#: how the rows are spoiled, what the error says (fixed phrases), in the order in which checks speak
FAILURES = [
    ("a column is missing", lambda s: _frame(s, _sound(), ["descriptor"]), "Missing required columns"),
    ("a key twice", lambda s: _frame(s, _spoiled("unique_key", ["K5"])), "1 duplicate values in 'unique_key'"),
    ("all keys null", lambda s: _frame(s, _spoiled("unique_key", [None] * 30)), "29 duplicate values"),
    ("agencies null, boroughs strange", lambda s: _frame(s, [r | {"borough": "Atlantis"} for r in _spoiled("agency", [None] * 9)]), "Null rate violations"),
    ("closed too early, boroughs strange", lambda s: _frame(s, [r | {"borough": "Atlantis"} for r in _spoiled("closed_date", [dt.datetime(1999, 1, 1)])]), "closed_date is before created_date"),
    ("boroughs strange", lambda s: _frame(s, _spoiled("borough", ["Lemuria", "Atlantis", "Lemuria"])), r"Unexpected borough values in 3 rows: \['Atlantis', 'Lemuria'\];"),
    ("many boroughs strange", lambda s: _frame(s, _spoiled("borough", list("gfedcba"))), r"in 7 rows: \['a', 'b', 'c', 'd', 'e'\] and more;"),
    ("nothing there", lambda s: s.createDataFrame([], "a string"), "0 rows"),
]


@pytest.mark.parametrize(("spoiled", "phrase"), [f[1:] for f in FAILURES], ids=[f[0] for f in FAILURES])
def test_strict_mode_names_the_first_failure(spark, spoiled, phrase):
    with pytest.raises(ValidationError, match=phrase):
        validate(spoiled(spark))


def test_one_check_alone_can_raise(spark):
    with pytest.raises(ValidationError, match="Null rate violations"):
        raise_first_failure(V.check_null_rates(_frame(spark, _spoiled("unique_key", [None]))))


def test_sound_rows_pass_everything(spark):
    report = validate(_frame(spark, _sound()))
    rows = report.orderBy("seq", F.col("subject").asc_nulls_first()).collect()
    assert all(r["passed"] for r in rows) and [r["seq"] for r in rows] == [1] + [2] * 10 + [3] + [4] * 5 + [5, 6]
