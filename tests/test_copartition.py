"""Co-partitioned staging and stored sketches."""

import random

import pytest
from pyspark.sql import functions as F

from tabflow.operators import (
    enrich,
    new_ref,
    quantile_sketches,
    rank_error,
    read_copartitioned,
    read_version,
    refresh,
    sketch_state,
    sketched_quantiles,
    stage_copartitioned,
)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sides(spark, n=4000):
    """A third of the fact on one key, null keys, keys without a partner and a
    dimension that repeats keys."""
    rnd = random.Random(2)
    keys = lambda: 7 if rnd.random() < 0.33 else rnd.choice([None, *range(40)])
    fact = spark.createDataFrame([(keys(), i, f"t{i % 5}") for i in range(n)], "key long, i long, name string")
    dim = spark.createDataFrame([(k, f"z{k}") for k in [None, *range(5, 60), 7, 8]], "id long, name string")
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left"])
def test_staged_pair_joins_as_enrich_without_an_exchange(spark, root, how):
    fact, dim = sides(spark)
    path = stage_copartitioned(fact, dim, "key", "id", "pair", new_ref(), 8, rows_per_task=100, root=root)
    pair = read_copartitioned(spark, path)
    where = F.col("i") % 3 > 0
    got = pair.enriched(where, how)
    assert got.columns == ["key", "i", "name", "name"]
    assert rows_of(got) == rows_of(enrich(fact.where(where), dim, "key", "id", how))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    again = read_copartitioned(spark.newSession(), path)
    assert again.fact.count() == fact.count()
    pair.forget(), again.forget()
    assert rows_of(read_copartitioned(spark, path).enriched(where, how)) == rows_of(enrich(fact.where(where), dim, "key", "id", how))


def test_a_hot_key_spans_buckets(spark, root):
    fact, dim = sides(spark)
    pair = read_copartitioned(
        spark, stage_copartitioned(fact, dim, "key", "id", "pair", new_ref(), 8, rows_per_task=100, root=root)
    )
    hot = pair.fact.where("key = 7").groupBy(F.input_file_name()).count().collect()
    assert len(hot) > 3 and sum(r["count"] for r in hot) == fact.where("key = 7").count()
    assert pair.fact.where("key IS NULL").select(F.input_file_name()).distinct().count() > 3


def test_empty_sides_and_refused_input(spark, root):
    fact, dim = sides(spark, 50)
    for f, d in ((fact.limit(0), dim), (fact, dim.limit(0))):
        pair = read_copartitioned(spark, stage_copartitioned(f, d, "key", "id", "pair", new_ref(), 4, root=root))
        assert rows_of(pair.enriched(how="left")) == rows_of(enrich(f, d, "key", "id", "left"))
    with pytest.raises(ValueError, match="different types"):
        stage_copartitioned(fact, dim, "key", "name", "pair", new_ref(), 4, root=root)
    with pytest.raises(ValueError, match="own column"):
        stage_copartitioned(fact.withColumn("_salt", F.lit(1)), dim, "key", "id", "pair", new_ref(), 4, root=root)
    with pytest.raises(LookupError):
        read_copartitioned(spark, f"{root}/nothing")


def test_sketches_merge_over_imports_within_their_error(spark, tmp_path):
    source, state = str(tmp_path / "values"), str(tmp_path / "state")
    rnd, values = random.Random(4), {"a": [], "b": []}
    for week in range(3):
        rows = [(rnd.choice("ab"), rnd.lognormvariate(0, 2)) for _ in range(20_000)]
        for key, value in rows:
            values[key].append(value)
        odd = [("a", None), ("b", float("nan")), ("c", None)]
        spark.createDataFrame(rows + odd, "k string, v double").repartition(3).write.mode("append").parquet(source)
        refresh(spark, state, source, sketch_state(["k"], "v"))
    wanted = (0.0, 0.01, 0.5, 0.99, 1.0)
    found = sketched_quantiles(read_version(spark, state), wanted).collect()
    assert len(found) == 3 * len(wanted)
    for r in found:
        if r["k"] == "c":
            assert r["n"] == 0 and r["value"] is None
            continue
        rank = sum(v <= r["value"] for v in values[r["k"]]) / len(values[r["k"]])
        assert r["n"] == len(values[r["k"]]) and abs(rank - r["p"]) <= 4 * rank_error(2000)
    empty = spark.createDataFrame([], "k string, v double")
    assert sketched_quantiles(quantile_sketches(empty, ["k"], "v"), wanted).count() == 0
    with pytest.raises(ValueError):
        sketched_quantiles(read_version(spark, state), [1.5])
