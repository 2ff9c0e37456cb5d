"""Relational building blocks shared by the pipelines and their reports
(joins J1/J2, filters F4/F5, top-N O3-O6, frequency A6, describe A9,
histogram A16, zero-filled categories A5, output contract K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions import nan_to_null, round_half
from tabflow.operators.quantiles import exact_quantiles
from tabflow.session import shared_dir


def enrich(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner") -> DataFrame:
    """``fact`` joined to ``dim`` on differently named keys; the dimension key
    is dropped, so the output is ``fact.*`` followed by ``dim.* minus key``.

    No broadcast hint: the planner broadcasts from measured sizes (and AQE
    from runtime sizes), and falls back to a shuffle join when the dimension
    is large. A non-unique dimension key multiplies fact rows, as in SQL;
    guard it with ``checks.unique``.
    """
    d = dim.alias("_dim")
    f = fact.alias("_fact")
    joined = f.join(d, F.col(f"_fact.`{fact_key}`") == F.col(f"_dim.`{dim_key}`"), how)
    dim_cols = [F.col(f"_dim.`{c}`") for c in dim.columns if c != dim_key]
    return joined.select(*[F.col(f"_fact.`{c}`") for c in fact.columns], *dim_cols)


def salted_enrich(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "inner",
    hot_fraction: float = 0.01,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """``enrich`` for a fact whose join key may be hot (one key holding a large
    share of all rows) and a dimension too large to broadcast.

    One partial aggregate counts the rows of each key (checkpointed when this
    is called, so the fact is read once more only, by the join). Keys with at least
    ``hot_fraction`` of the fact rows are hot; there are at most
    ``1 / hot_fraction`` of them, so that list is broadcast under a proven
    bound. A hot key is spread over as many salts as its count needs for
    ``rows_per_task`` rows each, and its dimension rows are repeated once per
    salt. Rows are dealt to salts in turn by their place in the partition, so
    equal rows spread too; a retried task deals alike as long as the fact
    replays its rows in order, as a file scan does (materialise it otherwise).
    Rows with a null key match nothing and are spread over all tasks. Same rows
    as ``enrich``.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_enrich supports inner and left joins")
    f, d = salted_sides(fact, dim, fact_key, dim_key, hot_fraction, rows_per_task)
    fa, da = f.alias("_f"), d.alias("_d")
    cond = (F.col(f"_f.`{fact_key}`") == F.col(f"_d.`{dim_key}`")) & (F.col("_f._salt") == F.col("_d._salt"))
    joined = fa.join(da, cond, how)
    return joined.select(
        *[F.col(f"_f.`{c}`") for c in fact.columns],
        *[F.col(f"_d.`{c}`") for c in dim.columns if c != dim_key],
    )


def salted_sides(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, hot_fraction: float, rows_per_task: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``salted_enrich`` with their ``_salt``: equal keys and
    equal salts join each fact row to all its dimension rows once."""
    if not 0 < hot_fraction <= 1 or rows_per_task < 1:
        raise ValueError("hot_fraction must lie in (0, 1] and rows_per_task be positive")
    shared_dir(fact.sparkSession)
    counts = fact.groupBy(F.col(f"`{fact_key}`").alias("_hot_key")).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    least = counts.select(F.sum("_n") * F.lit(float(hot_fraction))).scalar()
    hot = counts.where(F.col("_hot_key").isNotNull() & (F.col("_n") >= least)).select(
        "_hot_key", F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("long").alias("_salts")
    )
    hot_b = F.broadcast(hot)  # at most 1 / hot_fraction rows
    turn = F.monotonically_increasing_id()
    salt = F.when(F.col(f"_fact.`{fact_key}`").isNull(), turn).otherwise(
        F.pmod(turn, F.coalesce("_salts", F.lit(1).cast("long")))
    )
    f = (
        fact.alias("_fact")
        .join(hot_b, F.col(f"_fact.`{fact_key}`") == F.col("_hot_key"), "left")
        .select(*[F.col(f"_fact.`{c}`") for c in fact.columns], salt.alias("_salt"))
    )
    every = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1).cast("long")) - 1)
    d = (
        dim.alias("_dim")
        .join(hot_b, F.col(f"_dim.`{dim_key}`") == F.col("_hot_key"), "left")
        .select(*[F.col(f"_dim.`{c}`") for c in dim.columns], F.explode(every).alias("_salt"))
    )
    return f, d


def filter_in(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Keep rows whose ``column`` is in ``values``; no filter when the
    selection is empty (an empty ``isin`` would keep nothing)."""
    if not values:
        return df
    return df.where(F.col(column).isin(list(values)))


def filter_min(df: DataFrame, column: str, minimum: float | None) -> DataFrame:
    """Keep rows with ``column >= minimum``; no filter unless ``minimum > 0``."""
    if minimum is None or minimum <= 0:
        return df
    return df.where(F.col(column) >= F.lit(minimum))


def top_n(
    df: DataFrame,
    by: str,
    n: int | None = None,
    ties: Sequence[str] = (),
    descending: bool = True,
) -> DataFrame:
    """Rows ordered by ``by`` (descending by default) with unique tie-break
    keys ``ties``; the first ``n`` when ``n`` is given.

    With ``n`` the plan is a ``TakeOrderedAndProject``: each task keeps only
    its own top ``n``, so nothing larger than ``n`` rows per task moves.
    """
    key = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    ordered = df.orderBy(key, *[F.col(t).asc_nulls_last() for t in ties])
    return ordered.limit(n) if n is not None else ordered


def frequency(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Value counts of ``column``, most frequent first, null dropped
    (pandas ``value_counts``); ties ordered by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), F.col(column).asc())
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values (filter options)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def describe_column(df: DataFrame, column: str, digits: int | None = None) -> DataFrame:
    """One row: count, mean, exact median, sample std, min, max of ``column``.

    Null and NaN are skipped (pandas). The sample std of one value is null.
    An infinite value makes the mean infinite and the std NaN, as in pandas.
    The moments are one partial aggregate over the input; only the median runs
    the range path (``exact_quantiles``), whose jobs run when this is called.
    """
    x = nan_to_null(F.col(column))
    median = exact_quantiles(df, column, [0.5], ["median"]).scalar()
    out = df.select(x.alias("x")).agg(
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    out = out.select("count", "mean", median.alias("median"), "std", "min", "max")
    if digits is not None:
        out = out.select(
            "count", *[round_half(c, digits).alias(c) for c in ("mean", "median", "std", "min", "max")]
        )
    return out


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over ``[min, max]`` with ``bins`` bins.

    One row per bin, empty ones included: ``bin`` (1-based), ``bin_start``,
    ``bin_end``, ``count``. The maximum falls in the last bin. When all values
    are equal there is one bin, which holds everything; without values there
    is none. Null, NaN and infinite values are skipped: no equal-width bin has
    them. Lazy: the bounds are a one-row subquery, and the rows are counted
    per bin map-side, so the shuffle carries at most ``bins`` rows per task.
    """
    if bins < 1:
        raise ValueError("bins must be positive")
    x = nan_to_null(F.col(column))
    values = df.select(x.alias("v")).where(F.abs("v") < F.lit(float("inf")))
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = (bounds.select(c).scalar() for c in ("lo", "hi"))
    place = F.floor(F.lit(bins) * (F.col("v") - lo) / (hi - lo)) + 1
    bucket = F.when(lo == hi, F.lit(1).cast("long")).otherwise(F.least(place, F.lit(bins).cast("long")))
    counts = values.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = bounds.where("lo IS NOT NULL").select(
        "lo",
        ((F.col("hi") - F.col("lo")) / F.lit(bins)).alias("width"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.when(F.col("lo") == F.col("hi"), 1).otherwise(bins).cast("long"))).alias("bin"),
    )
    return (
        every.join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_end"),
            F.coalesce("n", F.lit(0)).cast("long").alias("count"),
        )
        .orderBy("bin")
    )


def complete_categories(
    agg: DataFrame,
    column: str,
    categories: Sequence[str],
    fill: dict[str, object],
) -> DataFrame:
    """Every category in ``categories`` order, left-joined to ``agg`` with the
    measures in ``fill`` defaulted for categories that have no rows (pandas
    ``observed=False``). Both sides hold at most one row per category, so
    the planner broadcasts them from their measured size."""
    # built in the JVM (no Python rows), so its size is known to the planner
    dim = agg.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias(column), F.lit(i).alias("_order")) for i, c in enumerate(categories)]
            )
        )
    )
    joined = dim.join(agg, column, "left")
    cols = [F.col(f"`{column}`")] + [
        F.coalesce(F.col(f"`{m}`"), F.lit(v)).alias(m) for m, v in fill.items()
    ]
    return joined.orderBy("_order").select(*cols)


def enforce_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Output contract: the frame must have exactly these columns; they are
    returned in the declared order."""
    have, want = list(df.columns), list(columns)
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    if missing or extra:
        raise ValueError(f"column contract broken: missing {missing}, unexpected {extra}")
    return df.select(*[F.col(f"`{c}`") for c in want])


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Number of rows as a one-row DataFrame (stays lazy, composes with
    other reports)."""
    return df.agg(F.count(F.lit(1)).alias(name))
