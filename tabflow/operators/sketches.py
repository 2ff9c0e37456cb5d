"""Quantile sketches that are stored per group and merged:
the approximate counterpart of ``exact_quantiles`` for groups that grow by
imports. A sketch is a few kilobytes whatever its group holds, and it is built
map-side, so a hot group is one sketch per task.

The sketches are Spark's own KLL aggregates. A quantile read from one has, with
99 % confidence, a rank within ``rank_error(k)`` of the wanted one, as a share
of the group's rows; merging keeps that bound. Nulls and NaN are skipped, as
in the exact path; a group without values has a null sketch and null quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions import nan_to_null
from tabflow.operators.incremental import MergeableState

DEFAULT_K = 2000


def rank_error(k: int) -> float:
    """The rank error of a sketch of size ``k`` that its authors publish
    (fitted, one quantile, 99 %): 0.14 % of the rows for the default."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, keys: Sequence[str], column: str, k: int = DEFAULT_K) -> DataFrame:
    """Per group: ``keys``, n (values) and sketch."""
    value = nan_to_null(F.col(f"`{column}`").cast("double"))
    sketch = F.when(F.count(value) > 0, F.kll_sketch_agg_double(value, F.lit(k)))
    return df.groupBy(*keys).agg(F.count(value).alias("n"), sketch.alias("sketch"))


def sketch_state(keys: Sequence[str], column: str, k: int = DEFAULT_K) -> MergeableState:
    """The same as a state that ``refresh`` keeps up with newly imported files."""
    return MergeableState(keys, lambda df: quantile_sketches(df, keys, column, k), {"n": "sum", "sketch": "kll"})


def sketched_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """A row per group and probability: the group's columns without the sketch,
    p and value."""
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities must lie in [0, 1]")
    value = lambda p: F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double("sketch", F.lit(p)))
    found = [F.struct(F.lit(p).alias("p"), value(p).alias("value")) for p in map(float, probabilities)]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], F.inline(F.array(*found)))
