"""Semantic traps checked on thousands of random values at once, against the
engines whose behaviour the pipelines keep (DuckDB rounding, Python
formatting, pandas binning)."""

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabflow.functions import bucket_label, fmt_count, fmt_decimal, ratio
from tabflow.plans.trips import DISTANCE_EDGES, DISTANCE_LABELS


def test_rounding_matches_duckdb_round(spark):
    rng = np.random.default_rng(1)
    n = rng.integers(1, 3000, 20000)
    k = (rng.random(20000) * n).astype(int)
    pdf = pd.DataFrame({"k": k, "n": n})
    got = ratio("k", "n", 4).alias("r")
    spark_vals = [r[0] for r in spark.createDataFrame(pdf).select(got).collect()]
    duck_vals = [r[0] for r in duckdb.sql("SELECT ROUND(k * 1.0 / n, 4) FROM pdf").fetchall()]
    assert spark_vals == duck_vals
    # the known tie: plain round(x, 4) would disagree here
    assert spark.range(1).select(ratio(F.lit(57), F.lit(800), 4)).first()[0] == 0.0712


def test_formatting_matches_python(spark):
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 10**9, 3000).tolist()
    decimals = (rng.random(3000) * 100).round(6).tolist() + [2.675, 0.125, 0.375, 1e-7, 999.995]
    cdf = spark.createDataFrame([(c,) for c in counts], "c long").select(fmt_count("c")).collect()
    ddf = spark.createDataFrame([(d,) for d in decimals], "d double").select(fmt_decimal("d", 2)).collect()
    assert [r[0] for r in cdf] == [f"{c:,}" for c in counts]
    assert [r[0] for r in ddf] == [f"{d:.2f}" for d in decimals]


def test_binning_matches_pandas_cut(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.uniform(-1, 9, 5000), [0.0, 2.0, 4.0, 6.0, np.nan, np.inf]])
    want = pd.cut(vals, bins=DISTANCE_EDGES, labels=DISTANCE_LABELS).astype(object)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(bucket_label("x", DISTANCE_EDGES, DISTANCE_LABELS)).collect()]
    want = [None if (isinstance(w, float) and np.isnan(w)) else w for w in want]
    assert got == want
