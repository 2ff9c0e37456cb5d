"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.session import shared_dir

# The white space of the text contracts, [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\f\r"
WORD_BREAK = "[ \\t-\\r]+"
NOT_SPACE = "[^ \\t-\\r]"

BATCH_BYTES = "1m"  # of rows sent to Python at a time
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_row: bool = False, **more: Column
) -> DataFrame:
    """The two columns every text operator works on, under fixed names;
    ``whole_row`` adds the input row as one struct, so that a filter can give
    the rows back without a join; ``more`` adds columns computed from it."""
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if whole_row else []
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        *row,
        *[c.alias(name) for name, c in more.items()],
    )


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python by their bytes, unless the session
    has a bound of its own. Spark's 10,000 rows are tens of megabytes of texts,
    which stand several times in a task: in the JVM, in Python and as results.
    A batch ends with the row that reaches the bound, so no row is left out."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of the cluster (spark.checkpoint.dir)."""
    return f"{shared_dir(spark)}/tabflow-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that
    survives lost executors and computes an expensive input once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def unsigned_hash(*cols: Column) -> Column:
    """A well-mixed non-negative 63-bit hash of the columns."""
    return F.xxhash64(*cols).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
