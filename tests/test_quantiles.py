"""Exact distributed quantiles against numpy (brute force on small fixtures)."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabflow.operators.quantiles import exact_median, exact_quantiles

PROBS = [0.0, 1 / 3, 0.5, 2 / 3, 0.9, 1.0]


def check(spark, values, buckets=None):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    got = exact_quantiles(df, "x", PROBS, [f"p{i}" for i in range(len(PROBS))], buckets).collect()[0]
    clean = np.array([v for v in values if v is not None and not np.isnan(v)], dtype=float)
    for i, p in enumerate(PROBS):
        if clean.size == 0:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(float(np.quantile(clean, p)), rel=1e-12, abs=1e-12)


def test_hot_value_third_of_rows(spark):
    rng = np.random.default_rng(7)
    values = list(rng.normal(size=400)) + [0.25] * 200  # one value holds a third of the rows
    check(spark, values, buckets=8)
    check(spark, values, buckets=1)


def test_nulls_nan_and_empty(spark):
    check(spark, [1.0, None, float("nan"), 3.0, 2.0], buckets=4)
    check(spark, [None, float("nan")], buckets=4)


def test_integers_many_duplicates(spark):
    rng = np.random.default_rng(3)
    check(spark, list(rng.integers(0, 20, size=500)), buckets=16)


def test_median_helper(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "x long")
    assert exact_median(df, "x").collect()[0][0] == 2.5


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.integers(-50, 50), st.none()), min_size=0, max_size=60), st.integers(1, 9))
def test_random_against_numpy(spark, values, buckets):
    check(spark, values, buckets)


def test_rejects_bad_probability(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        exact_quantiles(df, "x", [1.5])


def test_default_names_with_dots(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    row = exact_quantiles(df, "x", [0.5, 0.9]).collect()[0]
    assert row["q0.5"] == 5.0 and row["q0.9"] == 9.0


def test_default_multi_range_path(spark, monkeypatch):
    import tabflow.operators.quantiles as Q

    monkeypatch.setattr(Q, "RANGE_VALUES", 100)  # many ranges
    rng = np.random.default_rng(17)
    values = list(rng.normal(size=3000)) + [2.5] * 1500
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = Q.exact_quantiles(df, "x", PROBS, [f"p{i}" for i in range(len(PROBS))]).collect()[0]
    for i, p in enumerate(PROBS):
        assert got[i] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-12)
