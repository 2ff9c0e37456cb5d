"""Sinks: staged writes, write-audit-publish, table writes, SQL at a ref and
CSV export (SURVEY §2.2, K1-K10; S7, S11).

A *ref* names an isolated staging area below the shared folder from
``spark.checkpoint.dir``: ``<shared>/staging/<ref>/<table>``. Data is written
there, audited by the checks of ``checks`` on the same job (the rows are read
once), kept whether the audit passes or not, and copied to a target only by an explicit ``publish``.

An overwrite first writes a new folder beside the target and swaps it in when
the write has succeeded, so no write deletes what it reads and a failed one
leaves the old table. Beside its data files a table carries ``_tabflow.json``
with its schema, its partition columns and the verdict of its audit; Spark's
readers skip that file. ``read_table`` reads with that schema.

Limitation: the swap is two renames. A reader between them misses the table,
and an object store renames file by file; ``versions`` publishes by pointer
instead.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.operators.checks import FAIL, Check, CheckFailed, checked, row_metrics
from tabflow.operators.sql_names import table_references
from tabflow.session import shared_dir
from tabflow.sources import CSV_OPTIONS


def new_ref(prefix: str = "import") -> str:
    """A fresh staging ref from the UTC time, e.g. ``import_20210215_081500_1a2b``."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"{prefix}_{stamp}_{uuid.uuid4().hex[:6]}"


def staged_path(spark: SparkSession, table: str, ref: str, root: str | None = None) -> str:
    base = (root or shared_dir(spark)).rstrip("/")
    return f"{base}/staging/{ref}/{table.replace('.', '/')}"


METADATA = "_tabflow.json"

# In the folder names of a text partition column: Spark would read an empty
# text back as null, so it is written as the mark, and a text that starts with
# the mark gets one more.
EMPTY_MARK = "="


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its qualified Path: relative
    paths, ``..``, spaces and schemes are resolved the way Spark does."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hadoop)


def _inside(path: str, folder: str) -> bool:
    return path == folder or path.startswith(folder.rstrip("/") + "/")


def _roots(df: DataFrame) -> list[str]:
    """The folders and files that the plan of ``df`` reads, without listing them."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            roots = relation.location().rootPaths()
            out += [roots.apply(i).toString() for i in range(roots.size())]
    return out


def _reads_from(df: DataFrame, path: str) -> bool:
    """True when ``df`` reads from ``path``, below it or from a folder around it."""
    spark = df.sparkSession
    target = _file_system(spark, path)[1].toString()
    roots = [_file_system(spark, root)[1].toString() for root in _roots(df)]
    return any(_inside(root, target) or _inside(target, root) for root in roots)


def _text_partitions(schema: T.StructType, partition_by: Sequence[str]) -> list[str]:
    return [c for c in partition_by if isinstance(schema[c].dataType, T.StringType)]


def _marked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    marked = lambda c: F.when((c == "") | c.startswith(EMPTY_MARK), F.concat(F.lit(EMPTY_MARK), c)).otherwise(c)
    return df.withColumns({name: marked(F.col(f"`{name}`")) for name in columns})


def _unmarked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    plain = lambda c: F.when(c.startswith(EMPTY_MARK), F.substring(c, 2, 1 << 30)).otherwise(c)
    return df.withColumns({name: plain(F.col(f"`{name}`")) for name in columns})


def read_metadata(spark: SparkSession, path: str) -> dict:
    """What ``write_table`` stored beside the table; empty for other tables."""
    fs, folder = _file_system(spark, path)
    file = spark._jvm.org.apache.hadoop.fs.Path(folder, METADATA)
    if not fs.exists(file):
        return {}
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_metadata(spark: SparkSession, path: str, values: dict) -> None:
    fs, folder = _file_system(spark, path)
    stream = fs.create(spark._jvm.org.apache.hadoop.fs.Path(folder, METADATA), True)
    try:
        stream.write(bytearray(json.dumps(values).encode()))
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A written table with the schema and column order it was written with
    (partition values keep their type); any other Parquet folder as it is."""
    meta = read_metadata(spark, path)
    if not meta:
        return spark.read.parquet(path)
    schema = T.StructType.fromJson(meta["schema"])
    stored = spark.read.schema(schema).parquet(path)
    plain = _unmarked(stored, _text_partitions(schema, meta["partition_by"]))
    return plain.select(*[F.col(f"`{name}`") for name in schema.names])


def read_staged(spark: SparkSession, table: str, ref: str, root: str | None = None) -> DataFrame:
    """A table as it is in staging area ``ref`` (read at a ref)."""
    return read_table(spark, staged_path(spark, table, ref, root))


def query(spark: SparkSession, text: str, ref: str, root: str | None = None) -> DataFrame:
    """SQL text over the tables of a ref, by their plain names
    (``FROM ns.table``) or as ``{ns.table}``. Every relation the text reads must
    be staged at the ref; names of its own WITH clauses, and names inside
    strings and comments, are left alone. No view is registered, so two refs
    never mix."""
    quoted = re.sub(r"\{(\w+(?:\.\w+)*)\}", lambda m: ".".join(f"`{part}`" for part in m[1].split(".")), text)
    bound, tables, parts, at = {}, {}, [], 0
    for start, stop, name in table_references(spark, quoted):
        if name not in bound:
            fs, folder = _file_system(spark, staged_path(spark, name, ref, root))
            if not fs.exists(folder):
                raise LookupError(f"table {name} is not staged at ref {ref}")
            bound[name] = f"_table{len(bound)}"
            tables[bound[name]] = read_staged(spark, name, ref, root)
        parts += [_escaped(quoted[at:start]), "{", bound[name], "}"]
        at = stop
    return spark.sql("".join([*parts, _escaped(quoted[at:])]), **tables)


def _escaped(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


def drop_ref(spark: SparkSession, ref: str, root: str | None = None) -> bool:
    """Delete a staging area with all its tables; True if there was one."""
    base = (root or shared_dir(spark)).rstrip("/")
    fs, folder = _file_system(spark, f"{base}/staging/{ref}")
    return bool(fs.delete(folder, True))


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    metrics: Mapping[str, Column] | None = None,
    measured: dict | None = None,
    cluster_by: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """Materialise ``df`` at ``path`` (strategy REPLACE by default) and return
    the number of rows written, measured by an ``Observation`` on the same
    job (no second pass).

    An overwrite that reads from its own target is refused; any other one is
    written beside the target and swapped in. Parquet tables carry metadata.
    An append keeps the table's partition layout and refuses rows of other
    columns or types; the first one makes the table. ``metrics`` are further
    aggregates over the rows, taken on the same job; their values are put in
    ``measured``. The observed rows are those of the writing tasks, each
    counted once, also when a task is run again.

    ``cluster_by`` writes files of disjoint ranges, each sorted, so that the
    minima and maxima of row groups prune a range filter without a folder per
    value (``clustered``); it cannot go with ``partition_by``. Appends cluster
    the rows they add. ``options`` go to the writer.
    """
    spark = df.sparkSession
    if cluster_by and partition_by:
        raise ValueError("give partition_by or cluster_by, not both")
    if mode == "overwrite" and _reads_from(df, path):
        raise ValueError(f"refusing to overwrite {path}: the data being written is read from it")
    meta = read_metadata(spark, path) if mode == "append" and fmt == "parquet" else {}
    if meta:
        partition_by = _same_layout(df.schema, partition_by, meta, path)
        df = df.select(*[F.col(f"`{f['name']}`") for f in meta["schema"]["fields"]])
        if cluster_by is not None and list(cluster_by) != meta.get("cluster_by", []):
            raise ValueError(f"cannot append to {path}: it is clustered by {meta.get('cluster_by', [])}")
        cluster_by = meta.get("cluster_by")
    keys = list(partition_by or [])
    schema = df.schema
    if cluster_by:
        df = _with_range_values(clustered(df, cluster_by), cluster_by)
    obs = Observation("row_count")
    wanted = [F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in (metrics or {}).items())]
    observed = _marked(df.observe(obs, *wanted), _text_partitions(df.schema, keys))
    fs, target = _file_system(spark, path)
    if mode == "append" and fmt == "parquet" and not meta and fs.exists(target) and fs.listStatus(target):
        raise ValueError(f"cannot append to {path}: it carries no {METADATA}, so its schema is not known")
    fresh = f"{target.toString()}.{uuid.uuid4().hex}" if mode == "overwrite" else target.toString()
    writer = observed.write.mode("errorifexists" if mode == "overwrite" else mode).format(fmt).options(**dict(options or {}))
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(fresh)
    values = obs.get
    rows = int(values["rows"])
    if measured is not None:
        measured.update({name: values[name] for name in metrics or {}})
    if fmt == "parquet":
        # Rows that are appended have not been audited.
        own = meta or {
            "schema": schema.jsonValue(),
            "partition_by": keys,
            "cluster_by": list(cluster_by or []),
        }
        write_metadata(spark, fresh, own | {"audit": None})
    if mode == "overwrite":
        _swap(spark, fs, fresh, target)
    elif mode == "append":
        spark.catalog.refreshByPath(fresh)
    return rows


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows dealt to ranges of ``columns`` and sorted within each. A hash of
    the whole row is the last part of the range, so rows that share one value,
    however many, go to several tasks; only equal rows stay together."""
    if not columns:
        raise ValueError("name the columns to cluster by")
    keys = [F.col(f"`{c}`") for c in columns]
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.repartitionByRange(*keys, F.xxhash64(*hashable)).sortWithinPartitions(*keys)


# Spark's Parquet reader prunes no row groups by times without a zone, so a
# clustered table keeps their microseconds beside them under this prefix.
RANGE_VALUE = "_range_"


def _zoneless(schema: T.StructType, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(schema[c].dataType, T.TimestampNTZType)]


def _micros(time: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), time)


def _with_range_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({RANGE_VALUE + c: _micros(F.col(f"`{c}`")) for c in _zoneless(df.schema, columns)})


def read_range(spark: SparkSession, path: str, column: str, start, end) -> DataFrame:
    """The rows of a written table with ``start <= column < end`` (nulls go).
    Of a table clustered by ``column`` only the row groups whose range meets
    the bounds are read."""
    meta = read_metadata(spark, path)
    table = read_table(spark, path)
    kind = table.schema[column].dataType
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    value = F.col(f"`{column}`")
    wanted = (value >= low) & (value < high)
    if column not in _zoneless(table.schema, meta.get("cluster_by", [])):
        return table.where(wanted)
    kept = F.col(f"`{RANGE_VALUE}{column}`")
    stored = spark.read.schema(T.StructType([*table.schema.fields, T.StructField(RANGE_VALUE + column, T.LongType())]))
    found = stored.parquet(path).where((kept >= _micros(low)) & (kept < _micros(high)) & wanted)
    return found.select(*[F.col(f"`{c}`") for c in table.columns])


def _same_layout(schema: T.StructType, partition_by: Sequence[str] | None, meta: dict, path: str) -> list[str]:
    """The table's partition columns, if rows of ``schema`` fit the table."""
    table = T.StructType.fromJson(meta["schema"])
    own, theirs = ({f.name: f.dataType.simpleString() for f in x} for x in (table, schema))
    if own != theirs or len(table) != len(schema):
        differ = sorted(c for c in own.keys() | theirs.keys() if own.get(c) != theirs.get(c))
        raise ValueError(f"cannot append to {path}: columns {differ} are not those of the table")
    if partition_by is not None and list(partition_by) != meta["partition_by"]:
        raise ValueError(f"cannot append to {path}: it is partitioned by {meta['partition_by']}")
    return meta["partition_by"]


def _swap(spark: SparkSession, fs, fresh: str, target) -> None:
    """Put the folder ``fresh`` in the place of ``target``; the old one is
    deleted only once the new one stands there."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    old = path(f"{target.toString()}.{uuid.uuid4().hex}.old")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {target.toString()} aside; the new table is at {fresh}")
    if not fs.rename(path(fresh), target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move {fresh} to {target.toString()}")
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(target.toString())


def stage_table(
    df: DataFrame,
    table: str,
    ref: str,
    root: str | None = None,
    partition_by: Sequence[str] | None = None,
    cluster_by: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> tuple[str, int]:
    """Create-or-replace ``table`` in staging area ``ref``; returns
    ``(path, rows)``. Re-running with the same ref replaces the table, so the
    import is idempotent."""
    path = staged_path(df.sparkSession, table, ref, root)
    return path, write_table(df, path, "overwrite", partition_by, cluster_by=cluster_by, options=options)


@dataclass
class AuditResult:
    table: str
    ref: str
    path: str
    rows: int
    checks: list
    passed: bool

    def staged(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path)


def write_audit(
    df: DataFrame,
    table: str,
    ref: str,
    checks: Sequence[Check],
    root: str | None = None,
    raise_on_failure: bool = True,
    partition_by: Sequence[str] | None = None,
    cluster_by: Sequence[str] | None = None,
) -> AuditResult:
    """Write ``df`` to staging, audit the written table, keep it either way.

    Never publishes. Row checks are counted on the write's own job, so the
    audit reads nothing again; only ``unique`` checks read the staged table.
    With ``raise_on_failure`` a failing fail-severity check raises
    ``CheckFailed`` after the data is safely staged (kept for debugging);
    otherwise the result says whether it passed.
    """
    spark = df.sparkSession
    path = staged_path(spark, table, ref, root)
    counted: dict = {}
    rows = write_table(
        df, path, "overwrite", partition_by, metrics=row_metrics(df, checks), measured=counted, cluster_by=cluster_by
    )
    results = checked(read_table(spark, path), checks, counted)
    passed = all(r["passed"] or r["severity"] != FAIL for r in results)
    write_metadata(spark, path, read_metadata(spark, path) | {"audit": {"passed": passed, "checks": results}})
    result = AuditResult(table, ref, path, rows, results, passed)
    if raise_on_failure and not passed:
        raise CheckFailed([r for r in results if not r["passed"] and r["severity"] == FAIL])
    return result


def publish(
    spark: SparkSession, table: str, ref: str, target: str, root: str | None = None, allow_failed: bool = False
) -> int:
    """Copy a staged table to ``target`` (explicit publish step), in the same
    partition layout. The staged copy stays. Refuses a target that overlaps
    the staged path and, unless ``allow_failed``, a table whose audit failed."""
    source = staged_path(spark, table, ref, root)
    src, dst = (_file_system(spark, p)[1].toString() for p in (source, target))
    if _inside(dst, src) or _inside(src, dst):
        raise ValueError(f"publish target {target} overlaps the staged table {source}")
    meta = read_metadata(spark, source)
    audit = meta.get("audit")
    if audit and not audit["passed"] and not allow_failed:
        raise CheckFailed([r for r in audit["checks"] if not r["passed"] and r["severity"] == FAIL])
    rows = write_table(
        read_table(spark, source), target, "overwrite", meta.get("partition_by"), cluster_by=meta.get("cluster_by")
    )
    write_metadata(spark, target, read_metadata(spark, target) | {"audit": audit})
    return rows


def export_csv(df: DataFrame, path: str, limit: int | None = None) -> None:
    """CSV with a header, quoted the standard way (a quote inside a field is
    doubled; spaces and line breaks are kept). With ``limit`` the first rows
    come in one file; otherwise every partition writes its own."""
    out = df if limit is None else df.limit(limit).repartition(1)
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


ORDERED_PARTS = 100_000  # part numbers of five digits sort as text
_HEADER = "header.csv"  # sorts before the parts


def _csv_field(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if re.search(r'[",\r\n]|^\s|\s$|^$', name) else name


def export_csv_ordered(df: DataFrame, path: str, order: Sequence[str | Column], parts: int | None = None) -> None:
    """The whole table as CSV in the order given, written by many tasks: rows
    are dealt to ranges of ``order``, each range is sorted and written as one
    part, and parts are numbered in the order of their ranges, so all files of
    the folder one after another, by name, are the ordered table with the
    header once. ``parts`` is their number (default: shuffle partitions).

    Ties of ``order`` land in one part in no fixed order; end it with a key.
    The data is swapped in when it is complete. ``read_csv_ordered`` reads it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) if parts is None else parts
    if not 1 <= parts <= ORDERED_PARTS:
        raise ValueError(f"parts must be from 1 to {ORDERED_PARTS}")
    if _reads_from(df, path):
        raise ValueError(f"refusing to overwrite {path}: the data being written is read from it")
    fs, target = _file_system(spark, path)
    fresh = f"{target.toString()}.{uuid.uuid4().hex}"
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.write.mode("errorifexists").options(**CSV_OPTIONS | {"header": "false"}).csv(fresh)
    stream = fs.create(spark._jvm.org.apache.hadoop.fs.Path(fresh, _HEADER), True)
    try:
        stream.write(bytearray((",".join(_csv_field(c) for c in df.columns) + "\n").encode()))
    finally:
        stream.close()
    _swap(spark, fs, fresh, target)


def read_csv_ordered(spark: SparkSession, path: str, schema: T.StructType | str, position: str = "position") -> DataFrame:
    """An ordered export with the place of each row (from 1). Rows are numbered
    within their part, one task a part; only the parts' counts are summed over
    all parts."""
    parts = (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS | {"header": "false", "multiLine": "true"})
        .csv(f"{path.rstrip('/')}/part-*")
    )
    names = parts.columns
    numbered = parts.select("*", F.col("_metadata.file_name").alias("_part"), F.monotonically_increasing_id().alias("_at"))
    within = Window.partitionBy("_part").orderBy("_at")
    numbered = numbered.withColumn("_row", F.row_number().over(within))
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row a part, at most ORDERED_PARTS.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return numbered.join(F.broadcast(starts), "_part").select(
        *[F.col(f"`{c}`") for c in names], (F.col("_start") + F.col("_row")).alias(position)
    )
