"""CSV with line breaks inside fields, read in many splits, against pandas."""

import random

import pandas as pd
import pytest

from tabflow.sources.csv_records import read_csv_records, records


@pytest.fixture
def tiny_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "300")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _frame(seed, n):
    rng = random.Random(seed)
    part = lambda: rng.choice(['"', '""', "\n", "\n\n", ",", " ", "a", "é日", "x" * 40, "line\nbreak", '","', "\r\n"])
    texts = ["".join(part() for _ in range(rng.randint(1, 12))) for _ in range(n)]
    texts[n // 2] = "long\n" * 400 + '"' * 7  # spans many splits
    return pd.DataFrame({"n": range(n), "s": texts, "x": [rng.randint(0, 99) / 4 for _ in range(n)]})


@pytest.mark.parametrize("seed, line_end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_many_splits_equal_pandas(spark, tiny_splits, tmp_path, seed, line_end):
    for k in range(2):
        _frame(10 * seed + k, 150).to_csv(tmp_path / f"f{k}.csv", index=False, lineterminator=line_end)
    want = pd.concat([pd.read_csv(tmp_path / f"f{k}.csv", lineterminator=None) for k in range(2)])
    df = read_csv_records(spark, str(tmp_path), "n bigint, s string, x double")
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(zip(want.n, want.s, want.x, strict=True))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 30


def test_headers_blank_lines_and_empty_files(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('n,s\n1,"a\n\nb"\n\n2,""\n3,\n')
    df = read_csv_records(spark, str(path), "n bigint, s string")
    assert sorted(map(tuple, df.collect())) == [(1, "a\n\nb"), (2, None), (3, None)]  # as Spark and pandas
    with pytest.raises(ValueError, match="header"):
        read_csv_records(spark, str(path), "n bigint, t string")
    assert read_csv_records(spark, str(path), "n string, s string", header=False).count() == 4
    path.write_text("n,s\n")
    assert read_csv_records(spark, str(path), "n bigint, s string").count() == 0
    path.write_text("")
    assert read_csv_records(spark, str(path), "n bigint, s string").count() == 0


def test_records_are_cut_at_true_borders(spark, tiny_splits, tmp_path):
    path = tmp_path / "a.csv"
    rows = [f'{k},"{"q" * 50}\n,{k}"' for k in range(40)]
    path.write_text("k,s\n" + "\n".join(rows))
    found = records(spark, str(path))
    assert sorted(r["text"] for r in found.where("not first").collect()) == sorted(rows)
    assert [r["text"] for r in found.where("first").collect()] == ["k,s"]
