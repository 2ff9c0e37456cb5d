"""Versioned tables, appends, SQL by plain names, checks on the write job."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tabflow.operators import (
    CheckFailed,
    accepted_values,
    field_is,
    holds,
    in_range,
    new_ref,
    no_nulls,
    no_nulls_all,
    not_empty,
    query,
    read_table,
    run_checks,
    stage_table,
    unique,
    write_audit,
    write_table,
)
from tabflow.operators.sql_names import table_references
from tabflow.operators.versions import (
    PublishConflict,
    expire_versions,
    find_version,
    publish_version,
    read_version,
    version_path,
    versions,
    write_version,
)


def test_a_reader_never_misses_the_table(spark, root):
    """Each version holds one value n times; a reader sees whole versions in order."""
    path, seen, failed, done = os.path.join(root, "t"), [], [], threading.Event()
    write_version(spark.range(1).select(F.lit(1).alias("v")), path)

    def read():
        while not done.is_set():
            try:
                rows = [r["v"] for r in read_version(spark, path).collect()]
                seen.append(rows)
            except Exception as exc:  # the assertion below shows it
                failed.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(2, 22):
            write_version(spark.range(n).select(F.lit(n).alias("v")), path)
    finally:
        done.set()
        reader.join()
    assert not failed and len(seen) > 3
    assert all(rows == [len(rows)] * len(rows) for rows in seen)
    assert [len(rows) for rows in seen] == sorted(len(rows) for rows in seen)
    assert [v.number for v in versions(spark, path)] == list(range(1, 22))


def test_of_two_publishers_one_wins(spark, root):
    path = os.path.join(root, "t")
    write_version(spark.range(1), path)
    start, won, lost = threading.Barrier(4), [], []

    def publish(n):
        start.wait()
        try:
            won.append((write_version(spark.range(n), path, base=1), n))
        except PublishConflict:
            lost.append(n)

    writers = [threading.Thread(target=publish, args=(n,)) for n in (10, 20, 30, 40)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(won) == 1 and len(lost) == 3
    assert read_version(spark, path).count() == won[0][1] == won[0][0].rows
    assert len(os.listdir(os.path.join(path, "_data"))) == 2  # the losers' files are gone
    with pytest.raises(PublishConflict):
        write_version(spark.range(3), path, base=1)


def test_old_versions_stay_until_they_expire(spark, root):
    path = os.path.join(root, "t")
    with pytest.raises(LookupError):
        read_version(spark, path)
    made = []
    for n in (3, 2, 1):
        made.append(write_version(spark.range(n), path))
        time.sleep(0.01)
    for v, n in zip(made, (3, 2, 1), strict=True):
        assert read_version(spark, path, v.number).count() == read_version(spark, path, as_of=v.published_at).count() == n
    with pytest.raises(LookupError):
        find_version(spark, path, as_of="2001-01-01")
    with pytest.raises(ValueError):
        find_version(spark, path, 1, "2001-01-01")
    os.makedirs(os.path.join(path, "_data", "lost"))
    assert expire_versions(spark, path, keep=2) == [1]
    assert expire_versions(spark, path, keep=2, grace_seconds=-1) == []
    assert sorted(os.listdir(os.path.join(path, "_data"))) == sorted(v.folder for v in made[1:])
    with pytest.raises(LookupError):
        read_version(spark, path, 1)
    # the next one follows the newest, and may read the table it replaces
    assert write_version(read_version(spark, path, 2), path).number == 4
    assert read_version(spark, path).count() == 2
    # other readers get a version's folder; the table's own folder shows them no mixture
    assert spark.read.parquet(version_path(spark, path)).count() == 2
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(path)


def test_publish_keeps_layout_and_values(spark, root):
    ref, path = new_ref("v"), os.path.join(root, "t")
    df = spark.createDataFrame([("007", 1), ("a b", 2), (None, 3)], "part string, n long")
    write_audit(df, "t", ref, [not_empty()], root=root, partition_by=["part"])
    made = publish_version(spark, "t", ref, path, root)
    assert made.rows == 3 and made.audit["passed"]
    other = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(version_path(spark, path))
    assert sorted(map(str, (r["n"] for r in other.collect()))) == ["1", "2", "3"]
    assert sorted(map(tuple, read_version(spark, path).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    # a value that a folder name cannot keep is refused, and nothing changes
    for value in ("", "=x"):
        stage_table(spark.createDataFrame([(value, 1)], "part string, n long"), "t", ref, root, ["part"])
        with pytest.raises(ValueError, match="part"):
            publish_version(spark, "t", ref, path, root)
    write_audit(df.limit(0), "t", ref, [not_empty()], root=root, raise_on_failure=False)
    with pytest.raises(CheckFailed):
        publish_version(spark, "t", ref, path, root)
    assert [v.number for v in versions(spark, path)] == [1]


def test_append_keeps_schema_and_layout(spark, root):
    path = os.path.join(root, "t")
    first = spark.createDataFrame([("", 1), ("=z", 2)], "part string, n int")
    assert write_table(first, path, "append", ["part"]) == 2  # makes the table
    assert write_table(spark.createDataFrame([(3, "007")], "n int, part string"), path, "append") == 1
    assert sorted(map(tuple, read_table(spark, path).collect())) == [("", 1), ("007", 3), ("=z", 2)]
    for bad in ("part string, n double", "part string", "part string, n int, more int"):
        with pytest.raises(ValueError, match="append"):
            write_table(spark.createDataFrame([], bad), path, "append")
    with pytest.raises(ValueError, match="partitioned"):
        write_table(first, path, "append", ["n"])
    assert read_table(spark, path).count() == 3
    foreign = os.path.join(root, "foreign")
    spark.range(2).write.parquet(foreign)
    with pytest.raises(ValueError, match="schema is not known"):
        write_table(spark.range(1), foreign, "append")


TEXTS = [
    ("SELECT COUNT(*) AS n FROM ns.table", ["ns.table"]),
    ("select 'from a.b' x, \"from c\" y from d -- from e\n where k in (select k from f.g /* from h */)", ["d", "f.g"]),
    ("with t as (select * from t), u as (select * from t) select * from u, T join ns.u on true", ["t", "ns.u"]),
    ("with recursive r as (select 1 union all select * from r) select * from r", []),
    ("select (select max(a) from `w z`.`t.t`) from x union all select * from x", ["w z.t.t", "x", "x"]),
    ("select * from x where exists (with x as (select 1) select * from x, y)", ["x", "y"]),
    ("from ns.table select 1", ["ns.table"]),
    ("select * from values (1), (2) v", []),
]


@pytest.mark.parametrize("text, names", TEXTS)
def test_table_names_of_a_text(spark, text, names):
    found = table_references(spark, text)
    assert [n for _, _, n in found] == names
    assert all(text[a:b].replace("`", "") == n for a, b, n in found)


def test_sql_by_plain_names(spark, root):
    a, b = new_ref("a"), new_ref("b")
    for ref, n in ((a, 3), (b, 5)):
        stage_table(spark.range(n), "ns.table", ref, root)
        stage_table(spark.range(n).selectExpr("id", "'{ns.table} from x' AS s"), "other", ref, root)
    views = spark.catalog.listTables()
    text = "SELECT COUNT(*) AS n FROM ns.table"
    assert [query(spark, text, ref, root).first()["n"] for ref in (a, b)] == [3, 5]
    assert query(spark, "SELECT COUNT(*) AS n FROM {ns.table}", a, root).first()["n"] == 3
    text = "with t as (select * from ns.table where id > 0) select count(*) n, max('é{} from ns.gone') s from t join other o on t.id = o.id"
    assert tuple(query(spark, text, b, root).first()) == (4, "é{} from ns.gone")
    with pytest.raises(LookupError, match="ns.gone"):
        query(spark, "select * from ns.gone", a, root)
    assert spark.catalog.listTables() == views


def test_checks_on_the_write_job_give_the_same_verdicts(spark, root, tmp_path):
    source = str(tmp_path / "src")
    rows = [("high", 0.5, 1, 2), (None, float("nan"), None, 1), ("none", None, 3, -1), ("high", 2.0, 5, 1)]
    spark.createDataFrame(rows, "s string, r double, a long, b long").write.parquet(source)
    checks = [
        not_empty(), no_nulls("s"), accepted_values("s", ["high"]), in_range("r", 0, 1), no_nulls_all(["a", "b"]),
        holds("sane", "a <= b", ["a", "b"]), field_is("r", "double"), field_is("a", "int"), unique("s"),
    ]
    for frame in (spark.read.parquet(source), spark.read.parquet(source).limit(0)):
        got = write_audit(frame, "t", new_ref("c"), checks, root=root, raise_on_failure=False)
        assert got.checks == [r.asDict() for r in run_checks(got.staged(spark), checks).collect()]
        assert got.rows == frame.count()
    # the rows are read by one job, and only by the write
    tracker, group = spark.sparkContext.statusTracker(), f"write-{time.time()}"
    spark.sparkContext.setJobGroup(group, "")
    write_audit(spark.read.parquet(source), "t", new_ref("c"), checks[:-1], root=root, raise_on_failure=False)
    jobs = tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 2  # the footer of the source, and the write


def test_accepted_values_with_a_null_in_the_list(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert [r["violations"] for r in run_checks(df, [accepted_values("s", ["a", None])]).collect()] == [1]
