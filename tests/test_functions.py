"""Column functions and the semantic traps they guard."""

import math

import pytest
from pyspark.sql import functions as F

from tabflow.functions import (
    bucket_label,
    clean_avg,
    fmt_count,
    fmt_decimal,
    fmt_pct,
    ordinal,
    ratio,
    round_half,
    safe_ratio,
    strict_double,
)
from tabflow.plans.trips import DISTANCE_EDGES, DISTANCE_LABELS


def one(df):
    return df.collect()[0][0]


def test_round_half_tie_matches_sql_engines(spark):
    # 57/800 = 0.07125 -> 0.0712 (F.round(x, 4) gives 0.0713)
    df = spark.createDataFrame([(57, 800)], "c long, t long")
    assert one(df.select(ratio("c", "t", 4))) == 0.0712
    assert one(df.select(round_half(F.lit(2.5), 0))) == 3.0


def test_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (None, 2)], "c long, t long")
    assert [r[0] for r in df.select(ratio("c", "t")).collect()] == [None, None]
    assert one(df.limit(1).select(safe_ratio("c", "t"))) == 0.0


def test_clean_avg_skips_nan_and_null(spark):
    # T4: pandas mean of 1.0, NaN, null is 1.0; Spark's avg alone gives NaN
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert one(df.select(clean_avg("x"))) == 1.0
    assert math.isnan(one(df.select(F.avg("x"))))


def test_bucket_label_bins(spark):
    # Right-closed, 0 excluded, NaN / negative / null unbinned
    values = [0.0, 0.5, 2.0, 2.0001, 4.0, 6.0, 7.0, -1.0, float("nan"), None]
    expected = [None, "Short", "Short", "Medium", "Medium", "Long", "Very Long", None, None, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(bucket_label("x", DISTANCE_EDGES, DISTANCE_LABELS)).collect()]
    short = [None if g is None else g.split(" (")[0] for g in got]
    assert short == expected


def test_bucket_label_needs_matching_edges():
    with pytest.raises(ValueError):
        bucket_label("x", [0, 1], ["a", "b"])


def test_ordinal_default(spark):
    df = spark.createDataFrame([("high",), ("low",), ("other",), (None,)], "s string")
    got = [r[0] for r in df.select(ordinal("s", ["high", "medium", "low"])).collect()]
    assert got == [0, 2, 99, 99]


def test_formatting(spark):
    df = spark.createDataFrame([(1234567, 2.675, 0.125, 0.3807)], "n long, a double, b double, r double")
    row = df.select(
        fmt_count("n"), fmt_decimal("a"), fmt_decimal("b"), fmt_pct("r"), fmt_decimal(F.lit(1234.5))
    ).collect()[0]
    # Python's f"{2.675:.2f}" is 2.67 and f"{0.125:.2f}" is 0.12
    assert tuple(row) == ("1,234,567", "2.67", "0.12", "38.07%", "1234.50")
    assert f"{2.675:.2f}" == row[1] and f"{0.125:.2f}" == row[2]


def test_strict_double(spark):
    ok = spark.createDataFrame([("5.2",), (None,)], "s string")
    assert [r[0] for r in ok.select(strict_double("s")).collect()] == [5.2, None]
    for bad in ("abc", ""):
        df = spark.createDataFrame([(bad,)], "s string")
        with pytest.raises(Exception, match="cannot cast to double"):
            df.select(strict_double("s")).collect()
