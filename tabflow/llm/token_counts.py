"""Token counts: the exact histogram of encoded lengths, with suffix sums that
answer totals, quantiles and truncated totals for every context limit.

Edge cases: null and empty texts have 0 tokens and are counted; repeated rows
count each; an empty table gives an empty histogram; ids play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import documents, materialize
from tabflow.llm.tokens import encoder

BLOCK = 1024  # lengths summed by one window task


def token_lengths(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and n_tokens of every whole text."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in batches:
            lengths = [len(ids) // 4 for ids in tokens.encode(t.as_py() for t in batch[1])]
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(lengths, pa.int64())], names=["doc_id", "n_tokens"])

    return documents(docs, id_col, text_col).mapInArrow(encode, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per length: n_tokens, n_docs, the documents and tokens of that
    length or more (docs_from, tokens_from), the share of documents up to it
    (docs_share), and total_truncated, all tokens left if texts are cut at it.

    Suffix sums run in blocks of lengths and then over the blocks' totals, so
    no task sorts all lengths."""
    # One row per length, written once: both levels of sums read it, and texts are encoded only once.
    counts = (
        materialize(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
        .withColumn("block", F.expr(f"n_tokens div {BLOCK}"))
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    )
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    blocks = (
        counts.groupBy("block")
        .agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
        .select(
            "block",
            F.coalesce(F.sum("block_docs").over(above), F.lit(0)).alias("docs_above"),
            F.coalesce(F.sum("block_tokens").over(above), F.lit(0)).alias("tokens_above"),
            F.sum("block_docs").over(every).alias("all_docs"),
            F.sum("block_tokens").over(every).alias("all_tokens"),
        )
    )
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        "all_docs",
        "all_tokens",
        (F.col("docs_above") + F.sum("n_docs").over(within)).alias("docs_from"),
        (F.col("tokens_above") + F.sum("tokens").over(within)).alias("tokens_from"),
    )
    longer = F.col("docs_from") - F.col("n_docs")
    return summed.select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        ((F.col("all_docs") - longer) / F.col("all_docs")).alias("docs_share"),
        # Shorter texts whole, and every text of this length or more cut to it.
        (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("total_truncated"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: whole documents, cut documents and tokens kept."""
    n, docs = F.col("n_tokens"), F.col("n_docs")
    spread = histogram.select("n_tokens", "n_docs", F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("limit"))
    return spread.groupBy("limit").agg(
        F.sum(F.when(n <= F.col("limit"), docs).otherwise(0)).alias("whole_docs"),
        F.sum(F.when(n > F.col("limit"), docs).otherwise(0)).alias("cut_docs"),
        F.sum(F.least(n, F.col("limit")) * docs).alias("tokens"),
    )


def quantile(histogram: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of the documents reach down from."""
    return histogram.where(F.col("docs_share") >= share).agg(F.min("n_tokens").alias("n_tokens"))
