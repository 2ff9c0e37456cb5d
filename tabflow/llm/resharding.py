"""Resharding by minimum-cost flow: from old shard sizes and new capacities,
the block transfers that move the fewest bytes, then a rewrite of the affected
files only.

A layout is a folder ``shard=<i>`` for each shard; its files are the blocks.
The flow between shards (a small problem on shard totals) says how many bytes
of each old shard go to each new one. Within an old shard the files stand in
a fixed order; the flow cuts that line of bytes into stretches, one for each
destination. A file that lies in one stretch stays or goes whole; the few files
that a cut crosses are split document by document. Files that stay whole are
not touched.

A split file's documents go, largest first, to the destination that still
lacks most of its bytes, so that shards differ by a few small documents only.

Edge cases: a null text has size 1 (0 bytes plus 1); null doc_ids come first
in their file; repeated rows are placed one by one; an empty layout reads as
no rows; a shard number outside 0 to n - 1 is an error.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tabflow.llm.common import scratch_path, utf8_size

FILE = "_file"


def document_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 1."""
    return utf8_size(text) + 1


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: np.ndarray) -> np.ndarray:
    """The cheapest integer flow of all supplies into the capacities, by
    successive shortest paths with potentials. ``cost[i][j]``: of a byte from
    old shard i to new shard j, not negative. A few shards, so a small matrix."""
    n, m = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards cannot hold all bytes")
    flow = np.zeros((n, m), dtype=np.int64)
    left, room = np.array(supply, dtype=np.int64), np.array(capacity, dtype=np.int64)
    potential = np.zeros(n + m)
    while left.any():
        dist, came = np.full(n + m, np.inf), np.full(n + m, -1)
        queue = [(0.0, int(i)) for i in np.flatnonzero(left)]
        dist[[i for _, i in queue]] = 0.0
        while queue:
            d, u = heapq.heappop(queue)
            if d > dist[u]:
                continue
            if u < n:
                steps = cost[u] + potential[u] - potential[n:]
                ends = range(n, n + m)
            else:
                back = np.flatnonzero(flow[:, u - n])
                steps = -cost[back, u - n] + potential[u] - potential[back]
                ends = back.tolist()
            for v, step in zip(ends, steps, strict=True):
                if d + step < dist[v] - 1e-9:
                    dist[v], came[v] = d + step, u
                    heapq.heappush(queue, (float(dist[v]), int(v)))
        open_ends = np.flatnonzero(room > 0) + n
        end = int(open_ends[dist[open_ends].argmin()])
        potential += np.minimum(dist, dist[end])
        path = [end]
        while came[path[-1]] >= 0:
            path.append(int(came[path[-1]]))
        path.reverse()
        hops = list(zip(path, path[1:], strict=False))
        amount = min(int(left[path[0]]), int(room[end - n]), *(int(flow[b, a - n]) for a, b in hops if a >= n))
        for a, b in hops:
            if a < n:
                flow[a, b - n] += amount
            else:
                flow[b, a - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


def moving_cost(old: int, new: int) -> np.ndarray:
    """1 for a byte that moves, 0 for one that stays."""
    cost = np.ones((old, new))
    np.fill_diagonal(cost, 0.0)
    return cost


@dataclass(frozen=True)
class Layout:
    """The current files: whole ones of earlier folders, named by ``keep``
    (a table of shard and file, or none for all), and those of ``path``."""

    spark: SparkSession
    path: str
    schema: StructType
    earlier: Layout | None = None
    keep: str | None = None

    def read(self) -> DataFrame:
        """All rows with ``shard`` (int) and _file. The schema is given, as a
        folder may hold no file."""
        own = self.spark.read.schema(self.schema).parquet(self.path).withColumn(FILE, F.col("_metadata.file_path"))
        if self.earlier is None:
            return own
        kept = self.spark.read.parquet(self.keep)
        stay = self.earlier.read().join(kept, ["shard", FILE], "left_semi")
        return stay.unionByName(own, allowMissingColumns=True)


def write_layout(docs: DataFrame, shard: Column, path: str, text_col: str = "text") -> Layout:
    """Write the rows of ``docs`` into shard folders, each task its own files,
    with ``size``; an input column of the name shard, size or _file gives way."""
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "size", FILE)]
    sized = docs.select(*carried, shard.cast("int").alias("shard"), document_size(F.col(f"`{text_col}`")).alias("size"))
    sized.write.partitionBy("shard").parquet(path)
    return Layout(docs.sparkSession, path, sized.schema)


def _stretches(spark: SparkSession, flow: np.ndarray) -> DataFrame:
    """shard, low, high, new_shard: where each byte of an old shard goes. What
    stays comes first."""
    rows = []
    for i, row in enumerate(flow.tolist()):
        at = 0
        for j in sorted(range(len(row)), key=lambda j, i=i: (j != i, j)):
            if row[j]:
                rows.append((i, at, at + row[j], j))
                at += row[j]
    return spark.createDataFrame(rows, "shard int, low long, high long, new_shard int")


def _split(rows: DataFrame, carried: list[str], id_col: str) -> DataFrame:
    """``rows`` of files that are cut, with their new shard: largest first, to
    the destination that lacks most."""

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lacking = None, {}
        for batch in batches:
            shards = []
            for shard, file, size, wanted in zip(
                *(batch[n].to_pylist() for n in ("_old", FILE, "size", "_wanted")), strict=True
            ):
                if at != (shard, file):
                    at, lacking = (shard, file), {w["new_shard"]: w["amount"] for w in wanted}
                best = max(lacking, key=lacking.__getitem__)
                lacking[best] -= size
                shards.append(best)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in carried), pa.array(shards, pa.int32())], names=[*carried, "shard"]
            )

    own = [F.col(f"`{c}`") for c in carried]
    schema = rows.select(*own).schema.add("shard", IntegerType())
    return (
        rows.select(*own, F.col("shard").alias("_old"), FILE, F.col("wanted").alias("_wanted"))
        .repartition("_old", FILE)
        .sortWithinPartitions("_old", FILE, F.desc("size"), id_col, F.xxhash64(*own))
        .mapInArrow(placed, schema)
    )


def reshard(layout: Layout, capacities: Sequence[int] | int, old_shards: int, id_col: str = "doc_id", cost: np.ndarray | None = None) -> Layout:
    """The layout with the new capacities (or that many equal ones)."""
    spark = layout.spark
    rows = layout.read()
    files = rows.groupBy("shard", FILE).agg(F.sum("size").alias("bytes"))
    files_path = scratch_path(spark, "layout-files")
    files.write.parquet(files_path)
    files = spark.read.parquet(files_path)
    sizes = {r["shard"]: r["bytes"] for r in files.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
    if any(i is None or not 0 <= i < old_shards for i in sizes):
        raise ValueError(f"shards outside 0 to {old_shards - 1}: {sorted(sizes, key=str)}")
    supply = [sizes.get(i, 0) for i in range(old_shards)]
    capacities = equal_capacities(sum(supply), capacities) if isinstance(capacities, int) else list(capacities)
    flow = min_cost_flow(supply, capacities, moving_cost(old_shards, len(capacities)) if cost is None else cost)
    stretches = _stretches(spark, flow)
    before = Window.partitionBy("shard").orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("start", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    # The stretch list is bounded by shards: fewer than old + new of them in a cheapest flow.
    whole = files.join(F.broadcast(stretches), "shard").where(
        (F.col("low") <= F.col("start")) & (F.col("start") + F.col("bytes") <= F.col("high"))
    )
    placed_path, keep_path, path = (scratch_path(spark, f"layout-{n}") for n in ("placed", "keep", "files"))
    whole.select("shard", FILE, "new_shard").write.parquet(placed_path)
    placed = spark.read.parquet(placed_path)
    placed.where(F.col("shard") == F.col("new_shard")).select("shard", FILE).write.parquet(keep_path)

    carried = [c for c in rows.columns if c not in ("shard", FILE)]
    moved = rows.join(placed.where(F.col("shard") != F.col("new_shard")), ["shard", FILE])
    moved = moved.select(*[F.col(f"`{c}`") for c in carried], F.col("new_shard").alias("shard"))
    # What each destination gets of a file that is cut; at most one entry per new shard.
    cut = files.join(placed, ["shard", FILE], "left_anti").join(F.broadcast(stretches), "shard")
    amount = F.least("high", F.col("start") + F.col("bytes")) - F.greatest("low", "start")
    wanted = (
        cut.withColumn("amount", amount)
        .where("amount > 0")
        .groupBy("shard", FILE)
        .agg(F.array_sort(F.collect_list(F.struct("new_shard", "amount"))).alias("wanted"))
    )
    split = _split(rows.join(wanted, ["shard", FILE]), carried, id_col)
    out = moved.unionByName(split)
    out.write.partitionBy("shard").parquet(path)
    return Layout(spark, path, out.schema, layout, keep_path)


def slots(layout: Layout, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's place, from the files: doc_id, size, text_crc32, shard
    and slot, its number in the shard (files in order, then doc_id)."""
    rows = layout.read().select(
        F.col(f"`{id_col}`").alias("doc_id"),
        document_size(F.col(f"`{text_col}`")).alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")).alias("text_crc32"),
        "shard",
        FILE,
    )
    before = Window.partitionBy("shard").orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("shard", FILE).agg(F.count(F.lit(1)).alias("n"))
    files = files.select("shard", FILE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    in_file = Window.partitionBy("shard", FILE).orderBy("doc_id", "size", "text_crc32")
    return rows.join(files, ["shard", FILE]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.row_number().over(in_file) - 1).cast("long").alias("slot")
    )
