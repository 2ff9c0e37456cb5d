"""Exact quantiles without pulling a column into one task.

Spark's ``percentile`` / ``median`` are exact, but a global aggregate merges
every distinct value into the buffer of a single task. Here the work is
spread out instead:

1. count each distinct value (partial aggregation folds hot values early)
   and checkpoint that table to the shared ``spark.checkpoint.dir``;
2. deal the distinct values to ordered ranges of about ``RANGE_VALUES`` with
   Spark's range partitioner and checkpoint them with their range number, so
   that every later step sees the same ranges;
3. count rows per range (an aggregate, no sort) and derive per-range offsets
   from that table of one row per range;
4. only the ranges that hold a wanted rank (two per probability) get
   running counts, with a window partitioned by range;
5. read the values at the two ranks around ``q * (n - 1)`` and interpolate
   linearly, ``lo + (hi - lo) * frac`` (pandas / DuckDB ``quantile_cont``).

The number of ranges grows with the distinct values, so a range's size does
not; the answer is exact for any ranges because they are disjoint and ordered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions import nan_to_null
from tabflow.session import shared_dir

# Distinct values in a range, on average: what one task sorts.
RANGE_VALUES = 100_000


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct values ``v`` of ``column`` (null and NaN skipped) with their
    multiplicity ``n``, written once to the shared checkpoint folder.

    Every later step (ranges, range counts, running counts) reads these files instead of recomputing the upstream plan, and all of
    them see the same rows. Partial aggregation folds hot values before the
    shuffle.
    """
    v = nan_to_null(F.col(column)).alias("v")
    shared_dir(df.sparkSession)
    return (
        df.select(v)
        .where(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
        .checkpoint(eager=True)
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One-row DataFrame with the exact linear-interpolated quantiles of
    ``column`` (nulls and NaN skipped), one output column per probability.

    An empty input gives one row of nulls, like ``percentile`` would. Runs
    the input once when called (the ``value_counts`` checkpoint).
    """
    return quantiles_of_counts(value_counts(df, column), probs, names, buckets)


def quantiles_of_counts(
    counted: DataFrame,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``exact_quantiles`` over a ``value_counts`` table (columns ``v``, ``n``)."""
    names = list(names) if names is not None else [f"q{p}" for p in probs]
    if len(names) != len(probs):
        raise ValueError("one name per probability")
    for p in probs:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"probability out of range: {p}")

    ranges = buckets or max(1, math.ceil(counted.count() / RANGE_VALUES))
    keyed = (
        counted.repartitionByRange(ranges, "v")
        .withColumn("b", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    per_range = keyed.groupBy("b").agg(F.sum("n").alias("bn"))
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "b",
        "bn",
        F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("off"),
        F.sum("bn").over(Window.partitionBy()).alias("total"),
    )
    # only the ranges holding a wanted rank need running counts: at most
    # two per probability, so the broadcast and the sort stay small
    holds_rank = F.lit(False)
    for p in probs:
        position = F.lit(float(p)) * (F.col("total") - 1)
        for rank in (F.floor(position), F.ceil(position)):
            holds_rank = holds_rank | ((F.col("off") <= rank) & (rank < F.col("off") + F.col("bn")))
    needed = offsets.where(holds_rank).select("b", "off", "total")
    local = Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = keyed.join(F.broadcast(needed), "b").withColumn("upto_local", F.sum("n").over(local))

    upto = F.col("off") + F.col("upto_local")  # rows with value <= v
    first = upto - F.col("n")  # 0-based rank of the first copy of v
    pos = {name: F.lit(float(p)) * (F.col("total") - 1) for name, p in zip(names, probs)}

    aggs = [F.max("total").alias("_total")]
    for name in names:
        lo_rank, hi_rank = F.floor(pos[name]), F.ceil(pos[name])
        aggs.append(F.max(F.when((first <= lo_rank) & (lo_rank < upto), F.col("v"))).alias(f"_{name}_lo"))
        aggs.append(F.max(F.when((first <= hi_rank) & (hi_rank < upto), F.col("v"))).alias(f"_{name}_hi"))
        # (names may hold dots, e.g. the default "q0.5": always quote below)
    picked = ranked.agg(*aggs)

    out = []
    for name, p in zip(names, probs):
        lo, hi = F.col(f"`_{name}_lo`"), F.col(f"`_{name}_hi`")
        position = F.lit(float(p)) * (F.col("_total") - 1)
        frac = position - F.floor(position)
        out.append(F.when(F.col("_total") > 0, lo + (hi - lo) * frac).alias(name))
    return picked.select(*out)


def exact_median(df: DataFrame, column: str, name: str = "median") -> DataFrame:
    return exact_quantiles(df, column, [0.5], [name])
