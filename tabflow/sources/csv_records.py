"""Large CSV files with line breaks inside quoted fields, in many tasks
(SURVEY §2.1, S3).

A file is read as lines, split into blocks by size as any text. A line starts
a record when the quotes before it in the file are even in number. Each block
counts its quotes; the prefix sum over a file's blocks (one row each) says
whether a block starts inside a quoted field. Lines of a block are then put
together to records in one shuffle by block. Only the ends of blocks, a record
that goes on in the next block, meet in a second, small step. The records are
parsed by ``from_csv``.

The form is RFC 4180: a quote inside a field is doubled and its field is
quoted; a record ends with a line feed, with or without a carriage return
before it. Blank lines between records are skipped, as Spark and pandas do.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.session import shared_dir

QUOTE = '"'
BLOCK = ["file", "block"]


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(QUOTE), F.lit("")))


def _lines(spark: SparkSession, uri: str) -> DataFrame:
    """file, block (its start in the file), at (ascending in a block) and text of every line."""
    return spark.read.option("lineSep", "\n").text(uri).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )


def _open_blocks(lines: DataFrame) -> DataFrame:
    """file, block, inside: whether a block starts inside a quoted field."""
    blocks = lines.groupBy(*BLOCK).agg(F.sum(_quotes(F.col("text"))).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*BLOCK, F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2)).alias("inside"))


def _joined(order: str) -> Column:
    parts = F.array_sort(F.collect_list(F.struct(order, "text")))
    return F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")


def records(spark: SparkSession, uri: str) -> DataFrame:
    """file, first (the file's first record) and text of every record, line
    breaks inside included."""
    lines = _lines(spark, uri)
    placed = lines.join(_open_blocks(lines), BLOCK)
    in_block = Window.partitionBy(*BLOCK).orderBy("at")
    before = F.coalesce(F.sum(_quotes(F.col("text"))).over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.pmod(before + F.col("inside"), F.lit(2)) == 0
    placed = placed.withColumn("starts", starts.cast("long"))
    # 0: the lines that go on from an earlier block.
    placed = placed.withColumn("number", F.sum("starts").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = placed.groupBy(*BLOCK, "number").agg(_joined("at"), F.first("inside").alias("inside"))
    head = F.col("number") == 0
    open_end = F.pmod(_quotes(F.col("text")) + F.when(head, F.col("inside")).otherwise(0), F.lit(2)) == 1
    path = f"{shared_dir(spark)}/staging/csv_records_{uuid.uuid4().hex}"
    pieces = pieces.select(*BLOCK, "number", "text", (head | open_end).alias("part"))
    pieces.write.parquet(path)
    pieces = spark.read.schema(pieces.schema).parquet(path)
    whole = pieces.where(~F.col("part")).select("file", "block", "number", "text")
    # At most two parts a block: its head, and its last record if that goes on.
    in_file = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, 0)
    parts = pieces.where("part").withColumn("record", F.sum((F.col("number") > 0).cast("long")).over(in_file))
    place = F.struct("block", "number").alias("place")
    rest = parts.select("file", "record", place, "text").groupBy("file", "record").agg(_joined("place"), F.min("place").alias("place"))
    rest = rest.select("file", "place.block", "place.number", "text")
    every = whole.unionByName(rest)
    text = F.regexp_replace("text", "\r$", "")
    first = (F.col("block") == 0) & (F.col("number") == 1)
    return every.select("file", first.alias("first"), text.alias("text")).where(F.col("first") | (F.col("text") != ""))


def read_csv_records(
    spark: SparkSession,
    uri: str,
    schema: T.StructType | str,
    header: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV files as a table of ``schema``, by position. A header must name the
    columns of the schema in order. One scan counts quotes, one puts records
    together; both split large files."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    settings = {"quote": QUOTE, "escape": QUOTE, "multiLine": "true"}
    settings |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"} | dict(options or {})
    every = records(spark, uri)
    if header:
        names = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(schema))])
        seen = F.from_csv("text", names.simpleString()[7:-1].replace(":", " "), settings)
        heads = every.where("first").select(F.regexp_replace(F.array_join(F.array(*[seen[n] for n in names.names]), "\u0001"), "^﻿", "").alias("head"))
        other = heads.where(F.col("head") != "\u0001".join(schema.names)).first()
        if other is not None:
            raise ValueError(f"header {other['head'].split(chr(1))} does not name the columns {schema.names}")
        every = every.where(~F.col("first"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return every.select(F.from_csv("text", ddl, settings).alias("row")).select("row.*")
