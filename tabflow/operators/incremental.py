"""Incremental refresh of grouped tables from newly imported files (SURVEY
§2.5, A2, A3; D2, D4).

A *state* is one row per key with columns that merge: counts and sums add up,
flags and largest ids take the maximum. It stands in a versioned table. Beside
each version, below its folder, is the list of the files it holds, so state and
list are published by one pointer: a refresh that fails leaves both as they
were, and of two that start from one version one raises ``PublishConflict``.

A refresh lists the source, reads only the files that the list lacks, folds
them to partial states (map-side first, so a hot key is one row per task) and
adds those to the old state in one grouped aggregate. It reads no old source
file. The cost is one pass over the new files and one over the state.

A file is known by its path. One that is already in the state adds nothing. One
whose size or time has changed since raises ``ChangedFile``, as what it added
cannot be taken back; rebuild the state from all files then. Files that have
gone from the source stay in the state. Null keys form a group of their own
unless the partial state drops them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.operators.versions import Version, find_version, read_version, version_path, write_version
from tabflow.sources import read_source

FILES = "files"
MERGES: dict[str, Callable[[str], Column]] = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "kll": lambda c: F.when(F.count(c) > 0, F.kll_merge_agg_double(c)),
}


class ChangedFile(ValueError):
    """A file that the state holds has other contents now."""


@dataclass(frozen=True)
class MergeableState:
    """``partial`` turns source rows into one row per key (``keys`` and the
    columns of ``merge``); ``merge`` names how each column's values of one key
    combine: ``sum``, ``max``, ``min`` or ``kll`` (quantile sketches), all
    skipping nulls."""

    keys: Sequence[str]
    partial: Callable[[DataFrame], DataFrame]
    merge: Mapping[str, str]

    def merged(self, states: DataFrame) -> DataFrame:
        """One row per key out of several; columns keep their types."""
        types = {f.name: f.dataType for f in states.schema.fields}
        columns = [MERGES[how](c).cast(types[c]).alias(c) for c, how in self.merge.items()]
        return states.groupBy(*self.keys).agg(*columns)


@dataclass(frozen=True)
class Refreshed:
    version: Version
    new_files: int


def source_files(spark: SparkSession, uri: str | Sequence[str]) -> DataFrame:
    """path, length and modificationTime of the files at ``uri``, from the
    listing; no file is opened."""
    listed = spark.read.format("binaryFile").load(uri if isinstance(uri, str) else list(uri))
    return listed.select("path", "length", "modificationTime")


def imported_files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The files that a state holds, as they were when they were imported."""
    return spark.read.parquet(f"{version_path(spark, path, version)}/_{FILES}")


def _current(spark: SparkSession, path: str) -> Version | None:
    try:
        return find_version(spark, path)
    except LookupError:
        return None


def refresh(
    spark: SparkSession,
    path: str,
    uri: str | Sequence[str],
    state: MergeableState,
    read: Callable[[list[str]], DataFrame] | None = None,
) -> Refreshed:
    """Add the files at ``uri`` that the state at ``path`` lacks, and publish
    the result as its next version; without new files the state stays as it
    is. The first call makes the state. ``read`` opens a list of files
    (default: Parquet). The paths of new files pass through the driver, which
    names them to the reader."""
    now, base = source_files(spark, uri).dropDuplicates(["path"]), _current(spark, path)
    new = now
    if base is not None:
        held = imported_files(spark, path, base.number)
        both = now.join(held.select("path", F.struct("length", "modificationTime").alias("held")), "path", "left")
        changed = both.where("held is not null and held != struct(length, modificationTime)").select("path").first()
        if changed:
            raise ChangedFile(f"{changed['path']} has changed since it was imported; rebuild the state")
        new = both.where("held is null").drop("held")
    paths = sorted(row["path"] for row in new.select("path").toLocalIterator())
    if not paths and base is not None:
        return Refreshed(base, 0)
    if not paths:
        raise FileNotFoundError(f"no file at {uri}")
    partial = state.partial((read or (lambda files: read_source(spark, files)))(paths))
    partial = partial.select(*state.keys, *state.merge)
    files = new  # of the listing made above, so a file that arrives meanwhile waits for the next refresh
    if base is not None:
        partial = read_version(spark, path, base.number).select(*state.keys, *state.merge).unionByName(partial)
        files = held.unionByName(new)
    made = write_version(state.merged(partial), path, base=base.number if base else 0, beside={FILES: files})
    return Refreshed(made, len(paths))


def rebuild(
    spark: SparkSession,
    path: str,
    uri: str | Sequence[str],
    state: MergeableState,
    read: Callable[[list[str]], DataFrame] | None = None,
) -> Refreshed:
    """The state of all files at ``uri`` as the next version, whatever it held."""
    base = _current(spark, path)
    files = source_files(spark, uri).dropDuplicates(["path"])
    paths = sorted(row["path"] for row in files.select("path").toLocalIterator())
    if not paths:
        raise FileNotFoundError(f"no file at {uri}")
    partial = state.partial((read or (lambda found: read_source(spark, found)))(paths))
    merged = state.merged(partial.select(*state.keys, *state.merge))
    made = write_version(merged, path, base=base.number if base else 0, beside={FILES: files})
    return Refreshed(made, len(paths))
