"""Schemas of many Parquet files, read in tasks.

A Spark job over the files' paths reads each footer in its task and groups
equal ones by an aggregate. Only one path and a count of each distinct schema
come to the driver, where Spark's own reader turns that one footer into its
types. Tasks read footers with pyarrow, which needs a store it can open (local
or mounted, S3, GCS, HDFS with its library); elsewhere each file's footer is
read by Spark, from the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOOTER_THREADS = 16


@dataclass(frozen=True)
class SchemaGroup:
    """Files of one schema: their number, one of them, and the schema as Spark
    reads it. ``footer`` tells the group in ``file_footers``."""

    footer: str
    files: int
    example: str
    schema: T.StructType


def file_footers(spark: SparkSession, uri: str) -> DataFrame:
    """path and footer (the Parquet schema with Spark's own, as text) of every
    file at ``uri``; footer is null where a task cannot open the store."""

    # All it needs is imported inside, so workers need no copy of this package.
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import urlparse

        import pyarrow as pa
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        def footer(path: str) -> str | None:
            scheme = urlparse(path).scheme
            try:
                store, at = (fs.LocalFileSystem(), path.removeprefix("file:")) if scheme in ("", "file") else fs.FileSystem.from_uri(path)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                return None
            with store.open_input_file(at) as file:
                meta = pq.ParquetFile(file).metadata
            own = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"").decode()
            # The first line of the schema's text is an address in memory.
            return "\n".join([*str(meta.schema).split("\n")[1:], own])

        for batch in batches:
            paths = batch[0].to_pylist()
            found = pa.array([footer(p) for p in paths], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), found], names=["path", "footer"])

    files = spark.read.format("binaryFile").load(uri).select("path")  # the content is not read
    return files.mapInArrow(read, "path string, footer string")


def schema_groups(spark: SparkSession, uri: str) -> list[SchemaGroup]:
    """The distinct schemas of the files at ``uri``, in the order of their first path."""
    footers = file_footers(spark, uri)
    found = footers.groupBy("footer").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("example")).collect()
    known = [r for r in found if r["footer"] is not None]
    groups = [SchemaGroup(r["footer"], r["files"], r["example"], spark.read.parquet(r["example"]).schema) for r in known]
    if len(known) < len(found):  # a store that only Spark opens
        paths = [r["path"] for r in footers.where("footer is null").select("path").toLocalIterator()]
        with ThreadPoolExecutor(max_workers=FOOTER_THREADS) as pool:
            for path, schema in zip(paths, pool.map(lambda p: spark.read.parquet(p).schema, paths), strict=True):
                groups.append(SchemaGroup("", 1, path, schema))
    return sorted(groups, key=lambda g: g.example)


def merged(groups: list[SchemaGroup]) -> tuple[T.StructType, dict[str, list[str]]]:
    """All columns of the groups in order, and the types of those on which
    files disagree (such a column has its first type)."""
    fields, types = {}, {}
    for group in groups:
        for field in group.schema:
            fields.setdefault(field.name, T.StructField(field.name, field.dataType, True, field.metadata))
            types.setdefault(field.name, set()).add(field.dataType.simpleString())
    return T.StructType(list(fields.values())), {c: sorted(t) for c, t in types.items() if len(t) > 1}


def files_of(spark: SparkSession, uri: str, groups: list[SchemaGroup]) -> dict[T.StructType, list[str]]:
    """The paths of each schema's files, for a read of each schema on its own.
    Spark's file index holds the same paths on the driver."""
    by_footer = {g.footer: g.schema for g in groups if g.footer}
    out: dict[T.StructType, list[str]] = {g.schema: [] for g in groups}
    for g in groups:
        if not g.footer:
            out[g.schema].append(g.example)
    if by_footer:
        number = {footer: k for k, footer in enumerate(by_footer)}
        column = F.lit(-1)
        for footer, k in number.items():
            column = F.when(F.col("footer") == footer, k).otherwise(column)
        schemas = list(by_footer.values())
        rows = file_footers(spark, uri).where("footer is not null").select("path", column.alias("k"))
        for row in rows.toLocalIterator():
            out[schemas[row["k"]]].append(row["path"])
    return out
