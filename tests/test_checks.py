"""Data-quality checks."""

import pytest
from pyspark.sql import functions as F

from tabflow.operators.checks import (
    CheckFailed,
    accepted_values,
    assert_checks,
    field_is,
    holds,
    in_range,
    is_floating,
    no_nulls,
    no_nulls_all,
    not_empty,
    run_checks,
    unique,
)


def results(df, checks):
    return {(r["check"], r["column"]): (r["violations"], r["passed"], r["severity"]) for r in run_checks(df, checks).collect()}


def test_row_checks_in_one_aggregate(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5), (2, None, float("nan")), (3, "z", None), (3, "a", 1.0)], "k long, s string, r double"
    )
    checks = [
        no_nulls("s"),
        accepted_values("s", ["a", "b"]),
        in_range("r", 0, 1),
        no_nulls_all(["s", "r"]),
        holds("k_small", "k < 3", ["k"]),
        not_empty(),
        unique("k"),
        is_floating("r"),
        is_floating("s"),
    ]
    res = results(df, checks)
    assert res[("no_nulls", "s")][:2] == (1, False)
    assert res[("accepted_values", "s")][:2] == (1, False)
    assert res[("in_range", "r")][:2] == (1, False)  # NaN violates, null does not
    assert res[("no_nulls_all", "s,r")][:2] == (2, False)
    assert res[("k_small", "k")][:2] == (2, False)
    assert res[("not_empty", "")][:2] == (0, True)
    assert res[("unique", "k")][:2] == (1, False)
    assert res[("is_floating", "r")] == (0, True, "warn")
    assert res[("is_floating", "s")] == (1, False, "warn")


def test_field_is_both_outcomes(spark):
    df = spark.createDataFrame([(1,)], "k long")
    rows = run_checks(df, [field_is("k", "bigint"), field_is("k", "string")]).collect()
    assert [r["passed"] for r in rows] == [True, False]


def test_empty_table(spark):
    df = spark.createDataFrame([], "r double")
    res = results(df, [no_nulls("r"), in_range("r", 0, 1), not_empty()])
    assert res[("not_empty", "")][:2] == (1, False)
    assert res[("no_nulls", "r")][:2] == (0, True)


def test_assert_checks_raises_only_for_fail_severity(spark):
    df = spark.createDataFrame([("x",)], "s string")
    assert_checks(run_checks(df, [is_floating("s")]))  # warn: no raise
    with pytest.raises(CheckFailed, match="accepted_values"):
        assert_checks(run_checks(df, [accepted_values("s", ["a"])]))


def test_holds_with_column_predicate(spark):
    df = spark.createDataFrame([(1, 2), (3, 1), (None, 1)], "t long, c long")
    res = results(df, [holds("c_le_t", lambda: F.col("c") <= F.col("t"), ["t", "c"])])
    assert res[("c_le_t", "t,c")][:2] == (1, False)  # null row is not a violation


def test_run_checks_needs_checks(spark):
    with pytest.raises(ValueError):
        run_checks(spark.range(1), [])
