"""Corpus pipeline: quality rules, line dedup, near-dedup, benchmark
decontamination and packing, as stages over ``documents``.

Each stage gets the rows its predecessor kept and returns the columns of
``documents``; the last returns the packed pieces. Every stage's output is
written to the shared folder and read again, so a lost executor never costs
more than the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import materialize, read_table
from tabflow.llm.decontamination import drop_contaminated
from tabflow.llm.line_dedup import build_index, dedup_lines
from tabflow.llm.minhash import keep_one
from tabflow.llm.packing import pack_documents
from tabflow.llm.quality_rules import keep_good
from tabflow.llm.queries import PACK_END_ID, SEQUENCE_TOKENS, TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in the largest doc_id only;
    n_chars follows the text. A document may become empty; it stays."""
    left = dedup_lines(docs, build_index(docs))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words,
    similarity of 0.8 or more."""
    return keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces placed in sequences."""
    return pack_documents(docs, TOKENIZER, PACK_END_ID, SEQUENCE_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("decontamination", benchmark),
    ("packing", packing),
]

# SQL cannot express near-dedup and packing; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
