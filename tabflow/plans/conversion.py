"""Session-to-purchase conversion by customer segment.

Plan at scale
-------------
``session_conversion``: one hash aggregate keyed by session; the partial
aggregate runs before the shuffle, so a session that holds a third of all
events becomes one row per map task before anything moves.

``conversion_by_segment``: sessions are first reduced to one row per user
(``count``, ``sum(converted)``, again partial before the shuffle), and only
then joined to the users dimension. The join therefore sees at most one row
per user on the fact side, so a hot user cannot skew it, and its output is
folded per segment (a handful of groups). Counting per user first and
summing per segment after the join gives exactly the counts of the
row-level join, also when a user id repeats in the dimension.
No side is hinted for broadcast: the users dimension can be large, AQE picks
broadcast or shuffle join from the measured sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions import fmt_count, fmt_pct, ordinal, ratio, safe_ratio
from tabflow.operators.checks import (
    Check,
    accepted_values,
    holds,
    in_range,
    no_nulls,
    no_nulls_all,
    not_empty,
)
from tabflow.operators.incremental import MergeableState
from tabflow.operators.relational import enforce_columns

# Fixed values of the reference's conversion data product.
SEGMENT_ORDER = ["high", "medium", "low"]
OTHER_SEGMENT_ORDINAL = 99
OUTPUT_COLUMNS = ["customer_segment", "total_sessions", "converting_sessions", "conversion_rate"]
RATE_DIGITS = 4


def session_conversion(
    events: DataFrame,
    session: str = "user_session",
    user: str = "user_id",
    event: str = "event_type",
    goal: str = "purchase",
) -> DataFrame:
    """One row per non-null session: any user of it (the largest id) and a 0/1
    flag for whether it holds a ``goal`` event (null event types count as 0)."""
    flag = F.when(F.col(event) == F.lit(goal), 1).otherwise(0)
    return (
        events.where(F.col(session).isNotNull())
        .groupBy(session)
        .agg(F.max(user).alias(user), F.max(flag).alias("converted"))
    )


def session_state(goal: str = "purchase") -> MergeableState:
    """The mergeable state behind ``session_conversion``, for ``refresh``: a
    session whose events come in several files has converted if any part has."""
    return MergeableState(
        ["user_session"],
        lambda events: session_conversion(events, goal=goal),
        {"user_id": "max", "converted": "max"},
    )


def conversion_by_segment(
    sessions: DataFrame,
    users: DataFrame,
    user: str = "user_id",
    segment: str = "customer_segment",
    ordered: bool = True,
) -> DataFrame:
    """Sessions, converting sessions and the conversion rate (rounded to 4
    decimals) per non-null segment, highest rate first (``ordered=False``
    skips that sort for consumers that aggregate). Sessions whose user is
    unknown are not counted."""
    per_user = (
        sessions.where(F.col(user).isNotNull())
        .groupBy(user)
        .agg(F.count(F.lit(1)).alias("_sessions"), F.sum("converted").alias("_converting"))
    )
    dim = users.select(user, segment).where(F.col(segment).isNotNull() & F.col(user).isNotNull())
    by_segment = (
        per_user.join(dim, user, "inner")
        .groupBy(segment)
        .agg(
            F.sum("_sessions").cast("long").alias("total_sessions"),
            F.sum("_converting").cast("long").alias("converting_sessions"),
        )
        .withColumn("conversion_rate", ratio("converting_sessions", "total_sessions", RATE_DIGITS))
    )
    if ordered:
        by_segment = by_segment.orderBy(F.col("conversion_rate").desc_nulls_last(), F.col(segment).asc_nulls_last())
    return enforce_columns(by_segment.withColumnRenamed(segment, "customer_segment"), OUTPUT_COLUMNS)


def conversion_checks(values: Sequence[str] = SEGMENT_ORDER) -> list[Check]:
    """The gate on ``conversion_by_segment`` (E1-E5, plus E7 so that an empty
    result cannot pass vacuously)."""
    return [
        no_nulls("customer_segment"),
        accepted_values("customer_segment", values),
        no_nulls("conversion_rate"),
        in_range("conversion_rate", 0.0, 1.0),
        no_nulls_all(["total_sessions", "converting_sessions"]),
        holds(
            "counts_valid",
            lambda: (F.col("total_sessions") >= 0)
            & (F.col("converting_sessions") >= 0)
            & (F.col("converting_sessions") <= F.col("total_sessions")),
            ["total_sessions", "converting_sessions"],
        ),
        not_empty(),
    ]


def _segment_rank(order: Sequence[str]):
    return ordinal("customer_segment", order, OTHER_SEGMENT_ORDINAL)


def conversion_kpis(by_segment: DataFrame, order: Sequence[str] = SEGMENT_ORDER) -> DataFrame:
    """One row: total sessions, total conversions, overall (weighted) rate,
    0.0 for no sessions, and the best segment: highest rate, ties to the
    earlier segment in ``order``, then by name."""
    neg_rate = F.coalesce(-F.col("conversion_rate"), F.lit(float("inf")))
    rank_key = F.struct(neg_rate, _segment_rank(order), F.col("customer_segment"))
    return by_segment.agg(
        F.coalesce(F.sum("total_sessions"), F.lit(0)).cast("long").alias("total_sessions"),
        F.coalesce(F.sum("converting_sessions"), F.lit(0)).cast("long").alias("converting_sessions"),
        F.min_by("customer_segment", rank_key).alias("best_segment"),
    ).withColumn("overall_rate", safe_ratio("converting_sessions", "total_sessions"))


def best_segment(by_segment: DataFrame, order: Sequence[str] = SEGMENT_ORDER) -> DataFrame:
    """The highest-converting segment as one row (ties: earlier in ``order``)."""
    return by_segment.orderBy(
        F.col("conversion_rate").desc_nulls_last(), _segment_rank(order), F.col("customer_segment")
    ).limit(1)


def segment_report(by_segment: DataFrame, order: Sequence[str] = SEGMENT_ORDER) -> DataFrame:
    """Segments in business order (high, medium, low, others last), with the
    rate as percent and display text for each number."""
    return (
        by_segment.withColumn("_order", _segment_rank(order))
        .orderBy("_order", F.col("customer_segment").asc_nulls_last())
        .select(
            "customer_segment",
            "total_sessions",
            "converting_sessions",
            "conversion_rate",
            (F.col("conversion_rate") * F.lit(100.0)).alias("conversion_pct"),
            fmt_count("total_sessions").alias("sessions_text"),
            fmt_count("converting_sessions").alias("conversions_text"),
            fmt_pct("conversion_rate").alias("conversion_rate_text"),
        )
    )


def kpis_text(kpis: DataFrame) -> DataFrame:
    """The one-row ``conversion_kpis`` as displayed."""
    return kpis.select(
        fmt_count("total_sessions").alias("total_sessions_text"),
        fmt_count("converting_sessions").alias("converting_sessions_text"),
        fmt_pct("overall_rate").alias("overall_rate_text"),
        "best_segment",
    )


# The headings of the dashboard table.
def display_names(report: DataFrame) -> DataFrame:
    """The report with the column headings of the dashboard table."""
    return report.select(
        F.col("customer_segment").alias("Segment"),
        F.col("sessions_text").alias("Sessions"),
        F.col("conversions_text").alias("Conversions"),
        F.col("conversion_rate_text").alias("Conv. rate"),
    )
