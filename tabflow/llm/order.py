"""Places of rows in a global order, without a task that sees all of them.

Rows are dealt to ordered ranges, each range is numbered by itself, and what
stands before a range is summed up from one row per range and group. A group
that holds most rows spans many ranges, and equal rows can be split between
ranges, so no key meets one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import materialize

ROWS_PER_RANGE = 1 << 20


@dataclass(frozen=True)
class Ordered:
    """``dealt``: the rows with _range. ``spans``: a row for each range and
    group with _range, _local (the group's number in the range), what stands
    before it there and in earlier ranges, _group (the group's number in the
    order of groups, from 0), _group_rows, _group_size and the group columns."""

    dealt: DataFrame
    spans: DataFrame
    group: tuple[str, ...]
    order: tuple[str, ...]
    size: str | None

    def groups(self) -> DataFrame:
        """_group, _group_rows, _group_size and the group columns, a row per group."""
        return self.spans.where("_rows_before = 0").select("_group", "_group_rows", "_group_size", *self.group)

    def rows(self, of_group: DataFrame | None = None) -> DataFrame:
        """The rows with _group, _group_rows, _group_size, _position (in the
        group, from 0) and _before (sizes of the group's earlier rows), and the
        columns of ``of_group`` (a row per _group): they are joined to the
        spans, so a hot group is no hot join key."""
        spans = self.spans.drop(*self.group)
        added = [c for c in of_group.columns if c != "_group"] if of_group is not None else []
        if of_group is not None:
            spans = spans.join(of_group, "_group")
        ordered = Window.partitionBy("_range").orderBy(*self.group, *self.order, "_row")
        so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        size = F.col(self.size) if self.size else F.lit(0)
        placed = self.dealt.select(
            "*",
            F.row_number().over(ordered).alias("_number"),
            F.sum(size).over(so_far).alias("_sum"),
            F.dense_rank().over(Window.partitionBy("_range").orderBy(*self.group)).alias("_local"),
        )
        own = [c for c in self.dealt.columns if c not in ("_range", "_row")]
        return placed.join(spans, ["_range", "_local"]).select(
            *own,
            "_group",
            "_group_rows",
            "_group_size",
            (F.col("_number") - 1 - F.col("_rows_here") + F.col("_rows_before")).cast("long").alias("_position"),
            (F.col("_sum") - size - F.col("_size_here") + F.col("_size_before")).cast("long").alias("_before"),
            *added,
        )


def ordered(table: DataFrame, group: Sequence[str], order: Sequence[str], size: str | None = None) -> Ordered:
    """The rows of ``table`` (read from files, as it is read more than once)
    by group, then by ``order``, nulls first. Among equal rows any order holds."""
    spark = table.sparkSession
    by = [*group, *order, "_row"]
    # More ranges with more rows; a range is a task's share.
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(table.count() / ROWS_PER_RANGE))
    numbered = table.withColumn("_row", F.monotonically_increasing_id())
    dealt = materialize(numbered.repartitionByRange(ranges, *by).withColumn("_range", F.spark_partition_id()), "ranges")

    def earlier(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    in_range = Window.partitionBy("_range").orderBy(*group)
    in_group = Window.partitionBy(*group).orderBy("_range")
    whole = Window.partitionBy(*group)
    spans = dealt.groupBy("_range", *group).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.col(size) if size else F.lit(0)).alias("_size")
    )
    spans = spans.select(
        "_range",
        *group,
        F.row_number().over(in_range).alias("_local"),
        earlier("_rows", in_range).alias("_rows_here"),
        earlier("_size", in_range).alias("_size_here"),
        earlier("_rows", in_group).alias("_rows_before"),
        earlier("_size", in_group).alias("_size_before"),
        F.sum("_rows").over(whole).alias("_group_rows"),
        F.sum("_size").over(whole).alias("_group_size"),
    )
    spans = materialize(spans.withColumn("_new", (F.col("_rows_before") == 0).cast("long")), "spans")
    # One row per range: the groups that start in it and in earlier ones.
    starts = spans.groupBy("_range").agg(F.sum("_new").alias("_starts"))
    starts = starts.select("_range", earlier("_starts", Window.orderBy("_range")).alias("_groups_before"))
    new_here = F.sum("_new").over(in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered_spans = spans.withColumn("_new_here", new_here).join(starts, "_range")
    group_no = (F.col("_groups_before") + F.col("_new_here") - 1).alias("_group")
    kept = [c for c in spans.columns if c != "_new"]
    spans = materialize(numbered_spans.select(*kept, group_no), "spans")
    return Ordered(dealt, spans, tuple(group), tuple(order), size)
