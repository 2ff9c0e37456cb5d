"""Sources: import with schema detection and type overrides, declared scans
(SURVEY §2.1, S1-S12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions import strict_double
from tabflow.sources.footers import files_of, merged, schema_groups

# Standard CSV (RFC 4180): a quote inside a quoted field is doubled, and spaces belong to the field.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_source(
    spark: SparkSession,
    uri: str | Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Import one object, a glob or a list of paths as one table.

    Parquet keeps its own types (the reader prunes columns and pushes filters
    into the scan). CSV reads the standard form with a header; types come from
    ``schema`` when given, else from ``inferSchema`` (an extra pass over the
    files, so give a schema for large inputs). Line breaks inside quoted fields
    need ``options={"multiLine": "true"}``, which stops Spark from splitting
    large files, so it is not the default.
    """
    paths = [uri] if isinstance(uri, str) else list(uri)
    reader = spark.read
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
        if schema is None:
            reader = reader.option("inferSchema", True)
    reader = reader.options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(paths if len(paths) > 1 else paths[0])


def detect_schema(spark: SparkSession, uri: str, fmt: str = "parquet") -> T.StructType:
    """Schema of all files at ``uri``. Parquet: the columns of every file, from
    footers read in tasks; files that disagree on a type raise, as that needs a
    decision (``read_parquet_glob`` takes it)."""
    if fmt != "parquet":
        return read_source(spark, uri, fmt).schema
    schema, differ = merged(schema_groups(spark, uri))
    if differ:
        raise ValueError(f"the files disagree on the type of {differ}")
    # With the schema given, Spark adds the columns of partition folders.
    return spark.read.schema(schema).parquet(uri).schema


def field_type(df: DataFrame, name: str) -> str:
    """Spark simple type name of one field, e.g. ``double``."""
    return df.schema[name].dataType.simpleString()


def _cast(c: Column, source: T.DataType, target: str) -> Column:
    t = T.DataType.fromDDL(target) if isinstance(target, str) else target
    if isinstance(t, T.DoubleType) and isinstance(source, T.StringType):
        return strict_double(c)
    return c.cast(t)


def override_types(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast the named columns to new types after the read (Parquet cannot be
    read with a declared type that differs from the file). Unknown columns
    raise instead of being ignored. Text to double is strict: bad text raises.
    """
    unknown = [c for c in types if c not in df.columns]
    if unknown:
        raise ValueError(f"cannot override unknown column(s): {unknown}")
    return df.withColumns(
        {c: _cast(F.col(f"`{c}`"), df.schema[c].dataType, t) for c, t in types.items()}
    )


def read_parquet_glob(
    spark: SparkSession,
    uri: str,
    overrides: Mapping[str, str | T.DataType] | None = None,
) -> DataFrame:
    """A Parquet glob as one table, also when the files disagree on a type.

    Footers are read in tasks and only distinct schemas come to the driver
    (``footers``). The common case is then one read with the columns of all
    files. If the files disagree, ``overrides`` must name every column in
    conflict: each schema's files are read with their own types, cast, and the
    groups are unioned by name. A conflict that no override settles raises, and
    so does an override of a column that no file has.
    """
    overrides = dict(overrides or {})
    groups = schema_groups(spark, uri)
    if not groups:
        return override_types(spark.read.parquet(uri), overrides)  # Spark's own message
    schema, differ = merged(groups)
    if not differ:
        df = spark.read.schema(schema).parquet(uri)
        return override_types(df, overrides) if overrides else df
    unsettled = {c: t for c, t in differ.items() if c not in overrides}
    if unsettled:
        raise ValueError(f"the files disagree on the type of {unsettled}; name a type in overrides")
    unknown = [c for c in overrides if c not in schema.names]
    if unknown:
        raise ValueError(f"cannot override unknown column(s): {unknown}")
    frames = []
    for own, paths in files_of(spark, uri, groups).items():
        part = spark.read.schema(own).parquet(*paths)
        frames.append(override_types(part, {c: t for c, t in overrides.items() if c in part.columns}))
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def scan(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    filter: str | Column | None = None,
) -> DataFrame:
    """Declared input of a model: optional filter, then optional column list.

    The filter is applied before the projection so that it may use a column
    that is not kept; Catalyst still pushes both into the Parquet scan.
    """
    out = table
    if filter is not None:
        out = out.where(F.expr(filter) if isinstance(filter, str) else filter)
    if columns is not None:
        out = out.select(*[F.col(f"`{c}`") for c in columns])
    return out


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose ``df`` to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df
