"""Bindings from the test tables (TPC-H-like star schema plus ``events``) to
the roles the pipelines expect (SURVEY §7.3).

Every binding is a lazy projection of a Parquet table, so the column list and
any later filter still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the bindings: segment thresholds on the account balance,
# the trip window inside the lineitem ship dates, and miles per quantity unit.
HIGH_BALANCE = 6000
MEDIUM_BALANCE = 2500
TRIP_START = "1998-02-01"
TRIP_END = "1998-02-15"
MILES_DIVISOR = 4.0  # a power of two, so sums of miles are exact in any order
ALL_START = "1990-01-01"
ALL_END = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``, listed anew each time so
    that changed files are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_session`` = user id and calendar day of the event."""
    ev = table(spark, sf_dir, "events")
    session = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))
    return ev.select(session.alias("user_session"), "user_id", "event_type")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users, segmented by account balance."""
    bal = F.col("c_acctbal")
    segment = (
        F.when(bal >= HIGH_BALANCE, "high")
        .when(bal >= MEDIUM_BALANCE, "medium")
        .when(bal.isNotNull(), "low")
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), segment.alias("customer_segment")
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trips: ship date = pickup time, supplier = pickup
    location, part = drop-off location, the day after the pickup = drop-off
    time, quantity / 4 = miles."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("pickup_datetime"),
        (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
        (F.col("l_quantity") / F.lit(MILES_DIVISOR)).alias("trip_miles"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as zones: region name = borough, supplier name = zone."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("s_suppkey").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("s_name").alias("Zone"),
        )
    )


def engagement_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user: events as the engagement score, mean event value as
    the active minutes."""
    ev = table(spark, sf_dir, "events").where(F.col("user_id").isNotNull())
    return ev.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("double").alias("user_engagement_score"),
        F.avg("value").alias("daily_active_minutes_instagram"),
    )
