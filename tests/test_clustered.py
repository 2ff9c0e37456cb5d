"""Clustered staging and ordered CSV export (K6)."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabflow.operators import (
    export_csv_ordered,
    new_ref,
    publish_version,
    read_csv_ordered,
    read_range,
    read_table,
    read_version,
    stage_table,
    write_audit,
    write_table,
)
from tabflow.operators.staging import clustered, read_metadata
from tabflow.plans import bindings as B
from tabflow.plans import trips

SF = "/root/testdata/sf0.1"
SMALL_GROUPS = {"parquet.block.size": str(64 << 10)}


def row_groups(path, column):
    """(min, max, rows) of every row group, from the footers."""
    out = []
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(k).name for k in range(meta.num_columns)].index(column)
        groups = [meta.row_group(k) for k in range(meta.num_row_groups)]
        out += [(g.column(at).statistics.min, g.column(at).statistics.max, g.num_rows) for g in groups]
    return out


def scanned_rows(df):
    """Rows that the scan handed on, by Spark's own metric, after a run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_a_window_reads_few_row_groups_of_a_clustered_table(spark, root):
    li = B.trips(spark, SF)
    path, rows = stage_table(li, "trips", "r", root, cluster_by=["pickup_datetime"], options=SMALL_GROUPS)
    window = trips.time_window("pickup_datetime", B.TRIP_START, B.TRIP_END)
    groups = row_groups(path, "pickup_datetime")
    low, high = (spark.sql(f"SELECT TIMESTAMP'{t}' AS t").first()["t"] for t in (B.TRIP_START, B.TRIP_END))
    naive = lambda t: t.replace(tzinfo=None)
    hit = [g for g in groups if naive(g[0]) < high and naive(g[1]) >= low]
    assert len(groups) > 40 and len(hit) / len(groups) < 0.05
    found = read_range(spark, path, "pickup_datetime", B.TRIP_START, B.TRIP_END)
    assert scanned_rows(found) <= sum(g[2] for g in hit) < 0.05 * rows
    assert found.count() == li.where(window).count()
    assert read_table(spark, path).exceptAll(li).isEmpty() and rows == li.count()


def test_range_of_other_types_and_layouts(spark, root):
    df = spark.sql("SELECT id, if(id % 5 = 0, null, date_add(DATE'2020-01-01', CAST(id AS INT))) AS d FROM range(300)")
    stage_table(df, "t", "r", root, cluster_by=["d"])
    for layout in ("t", "plain"):
        path, _ = stage_table(df, layout, "r", root, cluster_by=["d"] if layout == "t" else None)
        got = sorted(r["id"] for r in read_range(spark, path, "d", "2020-01-11", "2020-02-01").collect())
        assert got == [k for k in range(10, 31) if k % 5]


def test_a_hot_value_goes_to_several_files(spark, root):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data would be joined to one task
    try:
        spread = clustered(df, ["k"]).withColumn("p", F.spark_partition_id()).where("k = 7").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and max(r["count"] for r in spread) < 5000


def test_rows_and_ranges_survive(spark, root):
    rows = [(k % 5 if k % 7 else None, f"x{k % 3}", {"m": k}) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, t string, m map<string,int>")
    path, n = stage_table(df, "t", "r", root, cluster_by=["k", "t"])
    assert n == 200
    key = lambda r: repr((r[0], r[1], r[2]))
    assert sorted(map(key, read_table(spark, path).collect())) == sorted(map(key, df.collect()))
    assert read_metadata(spark, path)["cluster_by"] == ["k", "t"]


def test_appends_and_publishing_keep_the_clustering(spark, root):
    path = f"{root}/t"
    df = spark.range(100).select("id")
    write_table(df, path, "append", cluster_by=["id"])
    write_table(df, path, "append")
    assert read_metadata(spark, path)["cluster_by"] == ["id"] and read_table(spark, path).count() == 200
    with pytest.raises(ValueError, match="clustered"):
        write_table(df, path, "append", cluster_by=["other"])
    ref = new_ref("c")
    write_audit(df, "c", ref, [], root=root, cluster_by=["id"])
    publish_version(spark, "c", ref, f"{root}/published", root=root)
    assert read_version(spark, f"{root}/published").count() == 100
    folder = glob.glob(f"{root}/published/_data/*")[0]
    assert read_metadata(spark, folder)["cluster_by"] == ["id"]


def test_bad_layouts_are_refused(spark, root):
    df = spark.range(3).select("id", F.lit(1).alias("p"))
    with pytest.raises(ValueError, match="not both"):
        write_table(df, f"{root}/t", partition_by=["p"], cluster_by=["id"])
    with pytest.raises(ValueError, match="name the columns"):
        clustered(df, [])


def test_empty_table_clustered(spark, root):
    path, rows = stage_table(spark.range(0), "t", "r", root, cluster_by=["id"])
    assert rows == 0 and read_table(spark, path).count() == 0


AWKWARD = [(k, f'a "{k}",\n b' if k % 4 else (None if k % 8 else f" {k} "), -k / 3) for k in range(500)]


def test_ordered_export_by_several_tasks(spark, root):
    df = spark.createDataFrame(AWKWARD, 'id long, `t,"x` string, x double').repartition(7)
    path = f"{root}/out"
    export_csv_ordered(df, path, [F.desc("id")], parts=5)
    parts = sorted(f for f in os.listdir(path) if f.endswith(".csv"))
    assert parts[0] == "header.csv" and len(parts) == 6
    import pandas as pd

    whole = f"{root}/whole.csv"
    with open(whole, "w", newline="") as out:
        for name in parts:
            with open(f"{path}/{name}", newline="") as file:
                out.write(file.read())
    got = pd.read_csv(whole)
    assert list(got.columns) == ["id", 't,"x', "x"]
    assert got["id"].tolist() == list(range(499, -1, -1))
    assert [None if pd.isna(v) else v for v in got['t,"x']] == [r[1] for r in reversed(AWKWARD)]
    back = read_csv_ordered(spark, path, df.schema).orderBy("position").collect()
    assert [tuple(r)[:3] for r in back] == [tuple(r) for r in reversed(AWKWARD)]
    assert [r["position"] for r in back] == list(range(1, 501))


def test_ordered_export_replaces_and_keeps_order_of_an_empty_table(spark, root):
    path = f"{root}/out"
    export_csv_ordered(spark.range(50), path, ["id"], parts=3)
    export_csv_ordered(spark.range(0), path, ["id"], parts=3)
    with open(f"{path}/header.csv") as file:
        assert file.read() == "id\n"
    assert read_csv_ordered(spark, path, "id long").count() == 0
    with pytest.raises(ValueError, match="parts"):
        export_csv_ordered(spark.range(1), path, ["id"], parts=0)
