"""Schema detection over many files, in tasks."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabflow.sources import detect_schema, field_type, read_parquet_glob
from tabflow.sources.footers import file_footers, schema_groups


def test_distinct_schemas_of_many_files(spark, tmp_path):
    base = tmp_path / "many"
    base.mkdir()
    for k in range(600):
        table = pa.table({"a": pa.array([k]), "b": pa.array([str(k)])})
        if k % 200 == 7:
            table = table.append_column("c", pa.array([k * 0.5]))
        pq.write_table(table, base / f"p{k:04d}.parquet")
    groups = schema_groups(spark, str(base))
    assert sorted(g.files for g in groups) == [3, 597]
    schema = detect_schema(spark, str(base))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [("a", "bigint"), ("b", "string"), ("c", "double")]
    df = read_parquet_glob(spark, f"{base}/*.parquet", {"b": "bigint"})
    assert field_type(df, "b") == "bigint"
    assert df.agg(F.sum("a"), F.sum("b"), F.count("c")).first() == (179700, 179700, 3)


def test_footers_are_read_by_a_distributed_job(spark, tmp_path):
    base = str(tmp_path / "t")
    spark.range(0, 400, 1, 20).write.parquet(base)
    footers = file_footers(spark, base)
    assert footers.count() == 20 and footers.select("footer").distinct().count() == 1
    assert "MapInArrow" in footers._jdf.queryExecution().executedPlan().toString()


def test_conflicts_name_the_columns(spark, tmp_path):
    base = str(tmp_path / "mixed")
    spark.range(3).selectExpr("id", "cast(id as double) x").write.parquet(f"{base}/one")
    spark.range(3).selectExpr("id", "cast(id as string) x", "id y").write.parquet(f"{base}/two")
    with pytest.raises(ValueError, match="x"):
        detect_schema(spark, f"{base}/*")
    with pytest.raises(ValueError, match="x"):
        read_parquet_glob(spark, f"{base}/*")
    with pytest.raises(ValueError, match="nope"):
        read_parquet_glob(spark, f"{base}/*", {"x": "double", "nope": "int"})
    df = read_parquet_glob(spark, f"{base}/*", {"x": "double"})
    assert df.agg(F.sum("x"), F.sum("y"), F.count(F.lit(1))).first() == (6.0, 3, 6)


def test_partition_folders_and_other_formats(spark, tmp_path):
    base, csv = str(tmp_path / "parts"), str(tmp_path / "csv")
    spark.range(10).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(base)
    assert detect_schema(spark, base).names == ["id", "k"]
    assert read_parquet_glob(spark, base).where("k = 1").count() == 5
    spark.range(3).write.option("header", True).csv(csv)
    assert detect_schema(spark, csv, "csv").names == ["id"]
    os.makedirs(tmp_path / "none")
    with pytest.raises(Exception):
        read_parquet_glob(spark, str(tmp_path / "none"))
