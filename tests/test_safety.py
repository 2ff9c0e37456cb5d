"""Writes that cannot lose data, values that survive a write, strict typing,
and gates on dimension keys."""

import datetime as dt
import os
import subprocess
import sys

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabflow.functions import strict_double
from tabflow.operators.checks import CheckFailed, no_nulls, not_empty
from tabflow.operators.quantiles import exact_quantiles
from tabflow.operators.relational import describe_column, enrich, histogram, salted_enrich
from tabflow.operators.staging import (
    drop_ref,
    export_csv,
    new_ref,
    publish,
    query,
    read_metadata,
    read_staged,
    read_table,
    stage_table,
    staged_path,
    write_audit,
    write_table,
)
from tabflow.plans import flows, trips
from tabflow.sources import read_parquet_glob, read_source

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("spell", ["relative", "spaced", "dotted", "uri", "inner", "outer"])
def test_overwriting_the_input_is_refused_however_it_is_spelled(spark, tmp_path, monkeypatch, spell):
    folder = tmp_path / "a folder" / "table"
    spark.range(3).write.parquet(str(folder))
    # the file system's working directory is the one Spark started in
    written = {
        "relative": os.path.relpath(folder, os.getcwd()),
        "spaced": str(folder),
        "dotted": str(folder.parent / "other" / ".." / "table"),
        "uri": f"file:{folder}",
        "inner": str(folder / "below"),
        "outer": str(folder.parent),
    }[spell]
    df = spark.read.parquet(str(folder)).withColumn("x", F.lit(1))
    with pytest.raises(ValueError, match="refusing"):
        write_table(df, written)
    assert spark.read.parquet(str(folder)).count() == 3


def test_a_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(3), path) == 3
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_table(bad, path)
    assert read_table(spark, path).count() == 3
    assert write_table(spark.range(7), path) == 7
    assert read_table(spark, path).count() == 7


ODD_KEYS = [("007", 1), ("", 2), (None, 3), ("=", 4), ("=x", 5), ("1e3", 6), ("a/b c", 7)]


def test_partition_values_are_unchanged(spark, root):
    df = spark.createDataFrame(ODD_KEYS, "part string, n long").withColumn("day", F.lit(dt.date(2021, 2, 1)))
    ref = new_ref("parts")
    audit = write_audit(df, "t", ref, [not_empty()], root=root, partition_by=["part", "day"])
    back = read_staged(spark, "t", ref, root)
    assert back.columns == df.columns and back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert back.where("part = ''").first()["n"] == 2
    target = os.path.join(root, "published")
    assert publish(spark, "t", ref, target, root) == len(ODD_KEYS)
    assert {d.split("=")[0] for d in os.listdir(target) if d[0] not in "._"} == {"part"}  # the layout is kept
    assert read_metadata(spark, target)["audit"]["passed"]
    assert sorted(map(tuple, read_table(spark, target).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert audit.rows == len(ODD_KEYS)


def test_publish_refuses_a_failed_audit(spark, root):
    ref, target = new_ref("failed"), os.path.join(root, "out")
    df = spark.createDataFrame([(None,)], "s string")
    assert not write_audit(df, "t", ref, [no_nulls("s")], root=root, raise_on_failure=False).passed
    with pytest.raises(CheckFailed):
        publish(spark, "t", ref, target, root)
    assert not os.path.exists(target)
    assert publish(spark, "t", ref, target, root, allow_failed=True) == 1
    assert drop_ref(spark, ref, root) and not os.path.exists(staged_path(spark, "t", ref, root))
    assert not drop_ref(spark, ref, root)


def test_sql_at_a_ref_sees_that_ref_only(spark, root):
    first, second = new_ref("a"), new_ref("b")
    for ref, n in ((first, 3), (second, 5)):
        stage_table(spark.range(n), "numbers", ref, root)
        stage_table(spark.range(1).select(F.lit(10 * n).alias("k")), "other", ref, root)
    text = "SELECT COUNT(*) AS n, MAX(k) AS k FROM {numbers} CROSS JOIN {other}"
    assert [tuple(query(spark, text, ref, root).first()) for ref in (first, second)] == [(3, 30), (5, 50)]


CSV_ROWS = [(1, 'say "hi", ok'), (2, "  outer spaces "), (3, "two\nlines"), (4, "a,b"), (5, "plain")]


def test_csv_is_read_as_pandas_reads_it(spark, tmp_path):
    df = spark.createDataFrame(CSV_ROWS, "n long, s string")
    path = str(tmp_path / "csv")
    export_csv(df, path, limit=10)
    (file,) = [f for f in os.listdir(path) if f.endswith(".csv")]
    seen = pd.read_csv(os.path.join(path, file))
    assert sorted(zip(seen.n, seen.s)) == CSV_ROWS
    back = read_source(spark, path, "csv", "n long, s string", {"multiLine": "true"})
    assert sorted(map(tuple, back.collect())) == CSV_ROWS
    made = str(tmp_path / "made.csv")
    pd.DataFrame(CSV_ROWS, columns=["n", "s"]).to_csv(made, index=False)
    assert sorted(map(tuple, read_source(spark, made, "csv", "n long, s string", {"multiLine": "true"}).collect())) == CSV_ROWS


def test_export_limit_bounds_the_single_file(spark, tmp_path):
    path = str(tmp_path / "csv")
    export_csv(spark.range(50), path, limit=5)
    assert spark.read.option("header", True).csv(path).count() == 5


@pytest.mark.parametrize("text", ["5.2d", "5.2f", "0x1p3", "1_0", "", "abc", "1e", "."])
def test_text_that_is_no_number_fails(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(strict_double("t"))
    with pytest.raises(Exception, match="cannot cast"):
        df.collect()


@pytest.mark.parametrize(("text", "value"), [("5.2", 5.2), ("-1e3", -1000.0), (" 7 ", 7.0), (".5", 0.5), ("3.", 3.0), ("inf", float("inf"))])
def test_text_that_is_a_number_is_read(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(strict_double("t")).first()[0] == value


def test_glob_conflicts_must_be_settled(spark, tmp_path):
    base = str(tmp_path / "g")
    spark.createDataFrame([(1, 1.5)], "id long, miles double").write.parquet(f"{base}/a")
    spark.createDataFrame([(2, "2.5")], "id long, miles string").write.parquet(f"{base}/b")
    with pytest.raises(ValueError, match="disagree"):
        read_parquet_glob(spark, f"{base}/*")
    with pytest.raises(ValueError, match="unknown"):
        read_parquet_glob(spark, f"{base}/*", {"miles": "double", "nope": "string"})
    assert sorted(map(tuple, read_parquet_glob(spark, f"{base}/*", {"miles": "double"}).collect())) == [(1, 1.5), (2, 2.5)]


TRIPS = "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID long, DOLocationID long, trip_miles double"


def test_missing_declared_columns_fail(spark):
    zones = spark.createDataFrame([(1, "B", "Z")], "LocationID long, Borough string, Zone string")
    rows = spark.createDataFrame([(dt.datetime(2021, 2, 2), None, 1, 2, 5.2)], TRIPS)
    assert "dropoff_datetime" in trips.trips_and_zones(rows, zones).columns
    with pytest.raises(ValueError, match="dropoff_datetime"):
        trips.trips_and_zones(rows.drop("dropoff_datetime"), zones)


def test_duplicate_dimension_keys_fail_the_flows(spark, tmp_path, root):
    src = str(tmp_path / "events")
    spark.createDataFrame([("s1", 1, "purchase")], "user_session string, user_id long, event_type string").write.parquet(src)
    users = spark.createDataFrame([(1, "high"), (1, "low")], "user_id long, customer_segment string")
    with pytest.raises(CheckFailed, match="unique"):
        flows.run_conversion_flow(spark, src, users, root=root)
    taxi = str(tmp_path / "taxi")
    spark.createDataFrame([(dt.datetime(2021, 2, 2), None, 1, 2, 5.2)], TRIPS).write.parquet(taxi)
    zones = spark.createDataFrame([(1, "B", "Z"), (1, "B", "Y")], "LocationID long, Borough string, Zone string")
    with pytest.raises(CheckFailed, match="unique"):
        flows.run_taxi_flow(spark, taxi, zones, root=root)


def _numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_histogram_fills_empty_bins_and_skips_infinity(spark):
    got = [(r["bin"], r["count"]) for r in histogram(_numbers(spark, [0.0, 10.0]), "x", 5).collect()]
    assert got == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 1)]
    odd = _numbers(spark, [0.0, 10.0, float("inf"), float("-inf"), float("nan"), None, 9.0])
    got = [tuple(r) for r in histogram(odd, "x", 2).collect()]
    assert got == [(1, 0.0, 5.0, 1), (2, 5.0, 10.0, 2)]
    assert histogram(_numbers(spark, [None]), "x", 3).count() == 0


def test_describe_with_infinity_is_pandas(spark):
    row = describe_column(_numbers(spark, [1.0, 2.0, float("inf")]), "x").first()
    assert row["count"] == 3 and row["mean"] == row["max"] == float("inf") and row["median"] == 2.0
    assert row["std"] != row["std"]  # NaN
    empty = describe_column(_numbers(spark, [None]), "x").first()
    assert empty["count"] == 0 and empty["mean"] is None and empty["median"] is None


def test_quantiles_sort_ranges_not_the_column(spark):
    df = spark.range(5000).select((F.col("id") % 997).cast("double").alias("x"))
    frame = exact_quantiles(df, "x", [0.5], ["m"], buckets=9)
    want = sorted(i % 997 for i in range(5000))
    assert frame.first()["m"] == (want[2499] + want[2500]) / 2


def test_salted_join_spreads_equal_rows_and_null_keys(spark):
    fact = spark.createDataFrame([(1, "same")] * 1000 + [(None, "same")] * 500 + [(2, "x")], "k long, v string")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "key long, name string")
    for how in ("inner", "left"):
        want = sorted(map(tuple, enrich(fact, dim, "k", "key", how).collect()), key=repr)
        got = salted_enrich(fact, dim, "k", "key", how, hot_fraction=0.1, rows_per_task=50)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    for bad in (0.0, -1.0, 1.5):
        with pytest.raises(ValueError, match="hot_fraction"):
            salted_enrich(fact, dim, "k", "key", hot_fraction=bad)


def test_entry_works_without_the_training_data_operators():
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'tabflow.llm') or name.startswith('tabflow.llm.'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as E\n"
        "from tabflow.plans.registry import QUERIES\n"
        "assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(QUERIES)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
