"""States refreshed from newly imported files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tabflow.operators import (
    ChangedFile,
    MergeableState,
    PublishConflict,
    expire_versions,
    imported_files,
    read_version,
    rebuild,
    refresh,
    versions,
)
from tabflow.operators import incremental
from tabflow.plans import conversion, trips

EVENTS = "user_session string, user_id long, event_type string"
TRIPS = "pickup_datetime timestamp, PULocationID long, trip_miles double"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def event_rows(seed, n):
    rnd = random.Random(seed)
    kinds = ["view", "purchase", None]
    return [(rnd.choice([None, *"abcdefgh"]), rnd.randrange(4), rnd.choice(kinds)) for _ in range(n)]


def add(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(folder)


def test_sessions_over_several_imports_equal_a_full_run(spark, tmp_path):
    source, state = str(tmp_path / "events"), str(tmp_path / "state")
    for week in range(4):
        add(spark, event_rows(week, 30), EVENTS, source)
        refresh(spark, state, source, conversion.session_state())
        full = conversion.session_conversion(spark.read.parquet(source))
        assert rows_of(read_version(spark, state)) == rows_of(full)
    assert len(versions(spark, state)) == 4


def test_importing_again_changes_nothing(spark, tmp_path):
    source, state = str(tmp_path / "events"), str(tmp_path / "state")
    add(spark, event_rows(1, 30), EVENTS, source)
    first = refresh(spark, state, source, conversion.session_state())
    again = refresh(spark, state, [source, source], conversion.session_state())
    assert first.new_files > 0 and again.new_files == 0
    assert again.version.number == first.version.number == 1


def test_only_new_files_are_read(spark, tmp_path):
    source, state, opened = str(tmp_path / "trips"), str(tmp_path / "state"), []

    def read(paths):
        opened.append(set(paths))
        return spark.read.parquet(*paths)

    rows = [("2021-02-03 10:00:00", 1, 2.0), ("2021-02-04 10:00:00", 1, float("nan")), (None, 1, 9.0)]
    for k in range(3):
        made = spark.createDataFrame([(t, p + k, m) for t, p, m in rows], "t string, PULocationID long, trip_miles double")
        made.select(F.col("t").cast("timestamp").alias("pickup_datetime"), "PULocationID", "trip_miles").write.mode(
            "append"
        ).parquet(source)
        refresh(spark, state, source, trips.pickup_state(), read)
    assert not opened[0] & opened[1] and not opened[1] & opened[2] and all(opened)
    assert imported_files(spark, state).count() == len(set.union(*opened))
    zones = spark.createDataFrame([(k, "B", f"Z{k}") for k in range(1, 4)], "LocationID long, Borough string, Zone string")
    full = trips.pickup_location_stats(spark.read.parquet(source), zones)
    assert rows_of(trips.locations_of_partials(read_version(spark, state), zones)) == rows_of(full)


def test_a_changed_file_is_refused_and_rebuilt(spark, tmp_path):
    source, state = str(tmp_path / "events"), str(tmp_path / "state")
    add(spark, event_rows(1, 30), EVENTS, source)
    refresh(spark, state, source, conversion.session_state())
    file = next(f for f in sorted(os.listdir(source)) if f.endswith(".parquet"))
    os.utime(os.path.join(source, file), (1, 1))
    with pytest.raises(ChangedFile):
        refresh(spark, state, source, conversion.session_state())
    assert len(versions(spark, state)) == 1
    rebuild(spark, state, source, conversion.session_state())
    assert refresh(spark, state, source, conversion.session_state()).new_files == 0
    assert rows_of(read_version(spark, state)) == rows_of(conversion.session_conversion(spark.read.parquet(source)))


def test_a_losing_refresh_leaves_state_and_list(spark, tmp_path):
    source, state = str(tmp_path / "events"), str(tmp_path / "state")
    add(spark, event_rows(1, 20), EVENTS, source)
    refresh(spark, state, source, conversion.session_state())
    add(spark, event_rows(2, 20), EVENTS, source)

    def read(paths):  # another refresh gets there first
        if len(versions(spark, state)) == 1:
            refresh(spark, state, source, conversion.session_state())
        return spark.read.parquet(*paths)

    with pytest.raises(PublishConflict):
        refresh(spark, state, source, conversion.session_state(), read)
    assert rows_of(read_version(spark, state)) == rows_of(conversion.session_conversion(spark.read.parquet(source)))
    assert refresh(spark, state, source, conversion.session_state()).new_files == 0


def test_expiry_takes_the_list_of_an_old_version(spark, tmp_path):
    source, state = str(tmp_path / "events"), str(tmp_path / "state")
    for week in range(3):
        add(spark, event_rows(week, 20), EVENTS, source)
        refresh(spark, state, source, conversion.session_state())
    expire_versions(spark, state, keep=1)
    assert len(os.listdir(f"{state}/_data")) == 1
    assert refresh(spark, state, source, conversion.session_state()).new_files == 0


def test_merges_keep_types_and_null_keys(spark, tmp_path):
    source, state = str(tmp_path / "t"), str(tmp_path / "state")
    spec = MergeableState(
        ["k"],
        lambda df: df.groupBy("k").agg(F.sum("x").alias("s"), F.max("x").alias("hi"), F.min("x").alias("lo")),
        {"s": "sum", "hi": "max", "lo": "min"},
    )
    for rows in ([("a", 1), (None, 5), ("b", None)], [("a", -4), (None, 7)]):
        add(spark, rows, "k string, x int", source)
        refresh(spark, state, source, spec)
    out = read_version(spark, state)
    assert out.schema["s"].dataType.simpleString() == "bigint" and out.schema["hi"].dataType.simpleString() == "int"
    assert rows_of(out) == rows_of(spec.partial(spark.read.parquet(source)))


def test_nothing_to_import(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        refresh(spark, str(tmp_path / "state"), str(tmp_path / "none"), conversion.session_state())
    assert incremental._current(spark, str(tmp_path / "state")) is None
