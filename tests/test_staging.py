"""Sources, staging, write-audit-publish and the import flows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tabflow.operators.checks import CheckFailed, not_empty
from tabflow.operators.staging import (
    export_csv,
    new_ref,
    publish,
    stage_table,
    staged_path,
    write_audit,
    write_table,
)
from tabflow.plans import flows
from tabflow.sources import (
    detect_schema,
    field_type,
    override_types,
    read_parquet_glob,
    read_source,
    register,
    scan,
)


def test_new_ref_is_unique():
    a, b = new_ref("import"), new_ref("import")
    assert a != b and a.startswith("import_")


def test_write_audit_keeps_data_on_failure(spark, root):
    df = spark.createDataFrame([(1, None)], "k long, s string")
    ref = new_ref("t")
    from tabflow.operators.checks import no_nulls

    with pytest.raises(CheckFailed):
        write_audit(df, "tbl", ref, [no_nulls("s"), not_empty()], root=root)
    kept = spark.read.parquet(staged_path(spark, "tbl", ref, root))
    assert kept.count() == 1  # staged table kept for debugging
    res = write_audit(df, "tbl", ref, [no_nulls("s")], root=root, raise_on_failure=False)
    assert not res.passed and res.rows == 1


def test_publish_refuses_self_overwrite(spark, root):
    df = spark.range(5)
    ref = new_ref("p")
    path, rows = stage_table(df, "nums", ref, root)
    assert rows == 5
    with pytest.raises(ValueError):
        publish(spark, "nums", ref, path, root)  # T11
    assert spark.read.parquet(path).count() == 5  # data intact
    target = os.path.join(root, "published", "nums")
    assert publish(spark, "nums", ref, target, root) == 5
    assert spark.read.parquet(target).count() == 5


def test_write_table_refuses_to_overwrite_its_input(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="refusing"):
        write_table(spark.read.parquet(path).withColumn("x", F.lit(1)), path)
    assert spark.read.parquet(path).count() == 3


def test_export_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    export_csv(spark.createDataFrame([(1, "a,b")], "n long, s string"), path, limit=10)
    files = glob.glob(f"{path}/*.csv")
    assert len(files) == 1
    assert open(files[0]).read().splitlines()[0] == "n,s"


def test_override_types_and_field_type(spark):
    df = spark.createDataFrame([(1.5, 2)], "trip_miles double, k long")
    as_text = override_types(df, {"trip_miles": "string"})
    assert field_type(as_text, "trip_miles") == "string"
    back = override_types(as_text, {"trip_miles": "double"})
    assert back.collect()[0]["trip_miles"] == 1.5
    with pytest.raises(ValueError, match="unknown"):
        override_types(df, {"nope": "string"})


def test_mixed_type_glob_is_cast_then_unioned(spark, tmp_path):
    base = str(tmp_path / "mixed")
    spark.createDataFrame([(1, 1.5)], "id long, trip_miles double").write.parquet(f"{base}/a")
    spark.createDataFrame([(2, "2.5")], "id long, trip_miles string").write.parquet(f"{base}/b")
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", True).parquet(f"{base}/*").schema
    out = read_parquet_glob(spark, f"{base}/*", {"trip_miles": "double"})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1.5), (2, 2.5)]
    assert field_type(out, "trip_miles") == "double"


def test_csv_source(spark, tmp_path):
    path = str(tmp_path / "users.csv")
    with open(path, "w") as fh:
        fh.write("user_id,age,user_engagement_score,last_login_date\n1,30,4.5,2025-01-02\n2,41,7.0,2025-02-03\n")
    inferred = read_source(spark, path, "csv")
    assert field_type(inferred, "age") == "int"
    typed = read_source(spark, path, "csv", schema="user_id long, age int, user_engagement_score double, last_login_date date")
    assert field_type(typed, "last_login_date") == "date"
    assert detect_schema(spark, path, "csv").fieldNames()[0] == "user_id"


def test_scan_filter_before_projection(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, s string")
    out = scan(df, ["s"], "k >= 2")
    assert out.columns == ["s"] and [r[0] for r in out.collect()] == ["b"]
    register(out, "scanned")
    assert spark.sql("SELECT COUNT(*) FROM scanned").collect()[0][0] == 1


def test_import_table_flow(spark, tmp_path, root):
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, 5.25)], "id long, trip_miles double").write.parquet(src)
    res = flows.import_table(spark, src, "trips", overrides={"trip_miles": "string"}, root=root)
    assert res.passed and res.rows == 1
    assert field_type(res.staged(spark), "trip_miles") == "string"
    names = {c["check"] for c in res.checks}
    assert names == {"not_empty", "field_is"}


def test_import_of_empty_source_fails_but_is_kept(spark, tmp_path, root):
    src = str(tmp_path / "empty")
    spark.createDataFrame([], "id long").write.parquet(src)
    ref = new_ref("e")
    with pytest.raises(CheckFailed, match="not_empty"):
        flows.import_table(spark, src, "events", ref, root=root)
    assert spark.read.parquet(staged_path(spark, "events", ref, root)).count() == 0


def test_taxi_flow_with_and_without_text_miles(spark, tmp_path, root):
    import datetime as dt

    src = str(tmp_path / "taxi")
    spark.createDataFrame(
        [(dt.datetime(2021, 2, 2), None, 1, 2, 5.2), (dt.datetime(2021, 2, 3), None, 1, 2, 1.0)],
        "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID long, DOLocationID long, trip_miles double",
    ).write.parquet(src)
    zones = spark.createDataFrame([(1, "Manhattan", "Midtown")], "LocationID long, Borough string, Zone string")
    tops = []
    for as_text in (False, True):
        res = flows.run_taxi_flow(spark, src, zones, miles_as_text=as_text, root=root)
        assert res.checks["trips_and_zones"][0]["passed"]  # T13: the cast makes trip_miles double
        tops.append([tuple(r) for r in spark.read.parquet(res.outputs["top_pickup_locations"]).collect()])
    assert tops[0] == tops[1] == [(1, "Manhattan", "Midtown", 2, pytest.approx(3.1))]


def test_conversion_flow(spark, tmp_path, root):
    src = str(tmp_path / "events")
    spark.createDataFrame(
        [("s1", 1, "purchase"), ("s2", 1, "view"), ("s3", 2, "view")],
        "user_session string, user_id long, event_type string",
    ).write.parquet(src)
    users = spark.createDataFrame([(1, "high"), (2, "low")], "user_id long, customer_segment string")
    res = flows.run_conversion_flow(spark, src, users, root=root)
    out = sorted(tuple(r) for r in spark.read.parquet(res.outputs["conversion_by_segment"]).collect())
    assert out == [("high", 2, 1, 0.5), ("low", 1, 0, 0.0)]


def test_engagement_flow_from_csv(spark, tmp_path, root):
    path = str(tmp_path / "users.csv")
    with open(path, "w") as fh:
        fh.write("user_id,user_engagement_score,daily_active_minutes_instagram\n")
        for i in range(30):
            fh.write(f"{i},{i % 10},{60 + i}\n")
    res = flows.run_engagement_flow(
        spark,
        path,
        schema="user_id long, user_engagement_score double, daily_active_minutes_instagram double",
        root=root,
    )
    summary = spark.read.parquet(res.outputs["segment_summary"]).orderBy("engagement_segment").collect()
    counts = {r["engagement_segment"]: r["users"] for r in summary}
    # scores 0..9 three times each; terciles at 3 and 6: low 0-3, medium 4-6, high 7-9
    assert counts == {"low": 12, "medium": 9, "high": 9}


def test_import_partitioned_prunes_directories(spark, tmp_path, root, capsys):
    import datetime as dt

    src = str(tmp_path / "events_src")
    spark.createDataFrame(
        [(1, dt.date(2021, 2, d)) for d in range(1, 11)], "id long, day date"
    ).write.parquet(src)
    res = flows.import_table(spark, src, "events", root=root, partition_by=["day"])
    staged = res.staged(spark).where(F.col("day") >= dt.date(2021, 2, 9))
    staged.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(day" in plan and staged.count() == 2
