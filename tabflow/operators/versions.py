"""Versioned tables: publish by pointer, read as of a version or a time
(SURVEY §2.2, K3, K7; §2.1, S7).

    <table>/_data/<unique>/            the files of one version, never changed
    <table>/_versions/<number>.json    the pointer to them, created if absent

A version's files are complete before its pointer is created, and a pointer is
created only once, so a reader finds the old version or the new one and never
misses the table. Two publishers that start from the same version ask for the
same number: one of them gets it, the other raises ``PublishConflict`` and
leaves nothing behind. Old versions stay until ``expire_versions``.

Creating a pointer: on a file system that is mounted (scheme ``file``) as a
hard link to a finished file; on one whose rename refuses an existing target
(HDFS) by that rename; elsewhere (object stores) by a create that does not
overwrite, where an object shows up whole when it is closed.

A plain ``spark.read.parquet(<table>)`` finds no files, as Spark skips names
with a leading underscore, so it cannot mix versions; ``version_path`` gives
the folder of one version to other readers.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.operators.checks import FAIL, CheckFailed
from tabflow.operators.staging import (
    EMPTY_MARK,
    _file_system,
    _text_partitions,
    read_metadata,
    read_table,
    staged_path,
    write_table,
)

POINTERS, DATA = "_versions", "_data"
_RENAME_REFUSES = ("hdfs", "viewfs", "webhdfs")


class PublishConflict(RuntimeError):
    """Another publisher has created the version first."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    published_at: str
    rows: int
    audit: dict | None


def _pointer(number: int) -> str:
    return f"{number:020d}.json"


def _read_text(spark: SparkSession, fs, file) -> str:
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _create_if_absent(spark: SparkSession, fs, folder: str, name: str, text: str) -> bool:
    """Create the file with its whole content; False if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    target, data = path(folder, name), text.encode()
    scheme = fs.getUri().getScheme()
    if scheme == "file":
        local = target.toUri().getPath()
        fresh = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(fresh, "wb") as out:
            out.write(data)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(fresh, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(fresh)
    if scheme in _RENAME_REFUSES:
        fresh = path(folder, f".{uuid.uuid4().hex}")
        stream = fs.create(fresh, False)
        stream.write(bytearray(data))
        stream.close()
        if fs.exists(target) or not fs.rename(fresh, target):
            fs.delete(fresh, False)
            return False
        return True
    try:
        stream = fs.createFile(target).overwrite(False).build()
        stream.write(bytearray(data))
        stream.close()
        return True
    except Exception as exc:
        if "exist" in str(exc).lower() or "precondition" in str(exc).lower():
            return False
        raise


def _version(spark: SparkSession, fs, folder, name: str) -> Version | None:
    """The version a pointer names; None if it has gone meanwhile."""
    file = spark._jvm.org.apache.hadoop.fs.Path(folder, name)
    try:
        return Version(**json.loads(_read_text(spark, fs, file)))
    except Exception:
        if fs.exists(file):
            raise
        return None


def _numbers(spark: SparkSession, path: str) -> tuple:
    fs, folder = _file_system(spark, f"{path.rstrip('/')}/{POINTERS}")
    if not fs.exists(folder):
        return fs, folder, []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return fs, folder, sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The versions of a table that are kept, oldest first."""
    fs, folder, numbers = _numbers(spark, path)
    found = [_version(spark, fs, folder, _pointer(n)) for n in numbers]
    return [v for v in found if v is not None]


def find_version(spark: SparkSession, path: str, version: int | None = None, as_of: datetime | str | None = None) -> Version:
    """The newest version; that of a number; or the newest published at or
    before a time (UTC unless it says otherwise)."""
    if version is not None and as_of is not None:
        raise ValueError("give a version or a time, not both")
    for _ in range(3):  # a pointer may expire between the listing and the reading
        fs, folder, numbers = _numbers(spark, path)
        if version is not None:
            numbers = [n for n in numbers if n == version]
        if as_of is None:
            numbers = numbers[-1:]
        found = [v for n in reversed(numbers) if (v := _version(spark, fs, folder, _pointer(n))) is not None]
        if as_of is not None:
            limit = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
            limit = limit.replace(tzinfo=timezone.utc) if limit.tzinfo is None else limit
            found = [v for v in found if datetime.fromisoformat(v.published_at) <= limit]
        if found:
            return found[0]
        if not numbers:
            break
    wanted = f"version {version}" if version is not None else f"version as of {as_of}" if as_of is not None else "version"
    raise LookupError(f"{path} has no {wanted}")


def version_path(spark: SparkSession, path: str, version: int | None = None, as_of: datetime | str | None = None) -> str:
    """The folder of a version's files, in a plain partition layout."""
    return f"{path.rstrip('/')}/{DATA}/{find_version(spark, path, version, as_of).folder}"


def read_version(
    spark: SparkSession, path: str, version: int | None = None, as_of: datetime | str | None = None
) -> DataFrame:
    """The table as it is now, at a version, or at a time."""
    return read_table(spark, version_path(spark, path, version, as_of))


def _refuse_marked(df: DataFrame, keys: Sequence[str]) -> None:
    """Text partition values that a folder name cannot keep as they are."""
    texts = _text_partitions(df.schema, keys)
    if not texts:
        return
    bad = [F.count_if((F.col(f"`{c}`") == "") | F.col(f"`{c}`").startswith(EMPTY_MARK)).alias(c) for c in texts]
    found = {c: n for c, n in df.agg(*bad).first().asDict().items() if n}
    if found:
        raise ValueError(
            f"partition values that are empty or start with {EMPTY_MARK!r} would change for other readers: {found}; "
            "publish without partitioning by these columns"
        )


def write_version(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    base: int | None = None,
    audit: dict | None = None,
    beside: Mapping[str, DataFrame] | None = None,
    cluster_by: Sequence[str] | None = None,
) -> Version:
    """Write ``df`` as the next version of the table at ``path``. It may read
    from the table itself. ``base`` is the version the writer started from
    (default: the newest when the call starts, 0 for none); if another one has
    been published since, ``PublishConflict`` is raised and the files go.
    ``beside`` are further tables of the version, published and expired with
    it, each in the folder ``_<name>`` below its files."""
    spark = df.sparkSession
    root = path.rstrip("/")
    if base is None:
        numbers = _numbers(spark, root)[2]
        base = numbers[-1] if numbers else 0
    _refuse_marked(df, list(partition_by or []))
    folder = uuid.uuid4().hex
    data = f"{root}/{DATA}/{folder}"
    try:
        rows = write_table(df, data, "errorifexists", partition_by, cluster_by=cluster_by)
        for name, table in (beside or {}).items():
            table.write.mode("errorifexists").parquet(f"{data}/_{name}")
        fs, pointers = _file_system(spark, f"{root}/{POINTERS}")
        fs.mkdirs(pointers)
        now = datetime.now(timezone.utc).isoformat()
        made = Version(base + 1, folder, now, rows, audit)
        later = [n for n in _numbers(spark, root)[2] if n > base]
        if later or not _create_if_absent(spark, fs, pointers.toString(), _pointer(made.number), json.dumps(vars(made))):
            raise PublishConflict(f"{path}: version {base + 1} was published by another writer")
    except (PublishConflict, PySparkException, OSError):
        fs, gone = _file_system(spark, data)
        fs.delete(gone, True)
        raise
    return made


def publish_version(
    spark: SparkSession,
    table: str,
    ref: str,
    target: str,
    root: str | None = None,
    base: int | None = None,
    allow_failed: bool = False,
) -> Version:
    """Publish a staged table as the next version of ``target`` (explicit
    step), in the same partition layout. Refused when its audit failed, unless
    ``allow_failed``."""
    source = staged_path(spark, table, ref, root)
    meta = read_metadata(spark, source)
    audit = meta.get("audit")
    if audit and not audit["passed"] and not allow_failed:
        raise CheckFailed([r for r in audit["checks"] if not r["passed"] and r["severity"] == FAIL])
    return write_version(
        read_table(spark, source), target, meta.get("partition_by"), base, audit, cluster_by=meta.get("cluster_by")
    )


def expire_versions(spark: SparkSession, path: str, keep: int = 2, grace_seconds: float = 3600) -> list[int]:
    """Delete all but the newest ``keep`` versions, and files of writers that
    ended without a pointer ``grace_seconds`` ago. A query that still reads an
    expired version fails; keep as many as run at once. Returns what expired.

    The pointers go first, so no reader finds a version whose files are gone.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    found = versions(spark, path)
    old, kept = found[:-keep], {v.folder for v in found[-keep:]}
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs, pointers = _file_system(spark, f"{path.rstrip('/')}/{POINTERS}")
    for v in old:
        fs.delete(hadoop(pointers, _pointer(v.number)), False)
    _, data = _file_system(spark, f"{path.rstrip('/')}/{DATA}")
    dead = {v.folder for v in old}
    for status in fs.listStatus(data) if fs.exists(data) else []:
        name = status.getPath().getName()
        lost = name not in kept and time.time() - status.getModificationTime() / 1000 > grace_seconds
        if name in dead or lost:
            fs.delete(status.getPath(), True)
    return [v.number for v in old]
