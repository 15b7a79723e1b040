"""Distributed statistics checked against brute force on small inputs."""

import random

import pytest

from civicspark.operators import stats as S


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(4)


def _median(values):
    s = sorted(values)
    return (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2


@pytest.mark.parametrize("n", [1, 2, 5, 100, 1001])
def test_exact_median(spark, n):
    rnd = random.Random(n)
    vals = [rnd.choice([None, round(rnd.uniform(-5, 5), 3)]) for _ in range(n)]
    present = [v for v in vals if v is not None]
    assert S.exact_medians(_frame(spark, vals), ["x"])["x"] == (_median(present) if present else None)


def test_exact_median_of_several_columns_in_one_search(spark):
    rnd = random.Random(7)
    rows = [(rnd.gauss(0, 1), rnd.choice([3.0, 4.0]), None) for _ in range(5001)]
    df = spark.createDataFrame(rows, "x double, y double, z double").repartition(5)
    got = S.exact_medians(df, ["x", "y", "z"])
    assert got == {"x": _median([r[0] for r in rows]), "y": _median([r[1] for r in rows]), "z": None}


def test_exact_median_ends_between_two_peaks(spark):
    vals = [0.0] * 6000 + [10.0] * 6000 + [1 + i / 100 for i in range(51)]  # mass on both ends, the median between
    assert S.exact_medians(_frame(spark, vals), ["x"])["x"] == _median(vals)


def test_exact_median_even_count_is_mean_of_middle_two(spark):
    assert S.exact_medians(_frame(spark, [1.0, 2.0, 4.0, 8.0]), ["x"])["x"] == 3.0
    assert S.exact_medians(_frame(spark, [1.0] * 4000 + [2.0] * 4000), ["x"])["x"] == 1.5


def test_exact_median_skips_nan(spark):
    nan = float("nan")
    df = _frame(spark, [1.0, nan, 3.0, None, 5.0])
    assert S.exact_medians(df, ["x"])["x"] == 3.0
    assert S.profile(df) == S.Profile(5, {"x": 2})
    assert S.exact_medians(_frame(spark, [nan, None]), ["x"])["x"] is None


def test_exact_median_hot_middle_value(spark):
    vals = [float(i) for i in range(3000)] + [1234.5] * 2500  # the hot value holds the middle
    assert S.exact_medians(_frame(spark, vals), ["x"])["x"] == 1234.5


def test_modes_smallest_on_ties_and_all_null(spark):
    df = spark.createDataFrame(
        [("b", None), ("a", None), ("b", None), ("a", None), (None, None), ("c", None)], "z string, w string"
    )
    assert S.modes(df, ["z", "w"]) == {"z": "a", "w": None}


def test_duplicate_count_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame([("1",), ("1",), ("2",), (None,), (None,), (None,)], "k string")
    assert S.duplicate_count(df, "k").first()["n_duplicates"] == 3


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "a long, b string")
    assert S.profile(df) == S.Profile(3, {"a": 2, "b": 2})
