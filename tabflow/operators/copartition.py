"""Co-partitioned staging of a fact and its dimension: both
sides are written in the same buckets of the join key, so that a join of the
staged pair, however often it is repeated, shuffles neither side.

The layout pays one shuffle of each side when it is made. A fact key that holds
at least ``hot_fraction`` of the rows is dealt to several salts, as in
``salted_enrich``, and the buckets are those of (key, salt); its dimension rows
are stored once per salt, so no bucket has to hold a hot key whole. Fact rows
with a null key are dealt over all buckets. A bucket is one file and one task
of the join: choose ``buckets`` so that rows / buckets fit a task.

The pair is laid out for one fact and one dimension: when either changes, stage
it anew. Spark knows buckets only for tables of its catalog, so reading
registers the two folders there under fresh names as external tables;
``forget`` removes these entries and leaves the files. Keys of both sides must
be of one type, because the bucket of a value depends on it. An empty side
gives the join of an empty table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.operators.relational import salted_sides
from tabflow.operators.staging import read_metadata, staged_path, write_metadata

SALT = "_salt"


@dataclass(frozen=True)
class CoPartitioned:
    """A staged pair; ``fact`` and ``dim`` carry their salt column."""

    fact: DataFrame
    dim: DataFrame
    fact_key: str
    dim_key: str
    tables: tuple[str, str]

    def enriched(self, where: Column | None = None, how: str = "inner") -> DataFrame:
        """``enrich`` of the staged sides, after ``where`` on the fact: same
        rows and columns, no exchange. The merge hint keeps the planner from
        collecting a side for a broadcast, which would not use the layout."""
        if how not in ("inner", "left"):
            raise ValueError("a co-partitioned pair supports inner and left joins")
        f = (self.fact if where is None else self.fact.where(where)).alias("_fact")
        d = self.dim.hint("merge").alias("_dim")
        same = (F.col(f"_fact.`{self.fact_key}`") == F.col(f"_dim.`{self.dim_key}`")) & (
            F.col(f"_fact.{SALT}") == F.col(f"_dim.{SALT}")
        )
        kept = [F.col(f"_fact.`{c}`") for c in self.fact.columns if c != SALT]
        added = [F.col(f"_dim.`{c}`") for c in self.dim.columns if c not in (SALT, self.dim_key)]
        return f.join(d, same, how).select(*kept, *added)

    def forget(self) -> None:
        """Remove the pair's entries from the catalog; the files stay."""
        for name in self.tables:
            self.fact.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def stage_copartitioned(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    name: str,
    ref: str,
    buckets: int,
    hot_fraction: float = 0.01,
    rows_per_task: int = 1_000_000,
    root: str | None = None,
) -> str:
    """Write both sides in ``buckets`` buckets below the staging area of
    ``ref`` and return the folder; the fact is read twice (key counts, rows)."""
    spark = fact.sparkSession
    types = fact.schema[fact_key].dataType, dim.schema[dim_key].dataType
    if types[0] != types[1]:
        raise ValueError(f"the keys are of different types: {types[0].simpleString()}, {types[1].simpleString()}")
    if SALT in (*fact.columns, *dim.columns):
        raise ValueError(f"{SALT} is the name of the layout's own column")
    path = staged_path(spark, name, ref, root)
    stored = {"buckets": buckets}
    sides = salted_sides(fact, dim, fact_key, dim_key, hot_fraction, rows_per_task)
    for side, rows, key in zip(("fact", "dim"), sides, (fact_key, dim_key), strict=True):
        entry = _entry()
        # Dealt as the buckets are, so that each bucket is one file.
        dealt = rows.repartition(buckets, F.col(f"`{key}`"), F.col(SALT))
        written = dealt.write.format("parquet").bucketBy(buckets, key, SALT).sortBy(key, SALT)
        written.option("path", f"{path}/{side}").saveAsTable(entry)
        spark.sql(f"DROP TABLE {entry}")  # external: the files stay
        stored[side] = {"key": key, "columns": rows._jdf.schema().toDDL()}
    write_metadata(spark, path, stored)  # last: without it the pair cannot be read
    return path


def read_copartitioned(spark: SparkSession, path: str) -> CoPartitioned:
    """The pair that ``stage_copartitioned`` wrote to ``path``, in any session."""
    stored = read_metadata(spark, path)
    if "buckets" not in stored:
        raise LookupError(f"no co-partitioned pair at {path}")
    entries = []
    for side in ("fact", "dim"):
        key, entry, place = stored[side]["key"].replace("`", "``"), _entry(), f"{path}/{side}".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {entry} ({stored[side]['columns']}) USING parquet "
            f"CLUSTERED BY (`{key}`, {SALT}) SORTED BY (`{key}`, {SALT}) INTO {stored['buckets']} BUCKETS LOCATION '{place}'"
        )
        entries.append(entry)
    fact, dim = (spark.table(e) for e in entries)
    return CoPartitioned(fact, dim, stored["fact"]["key"], stored["dim"]["key"], tuple(entries))


def _entry() -> str:
    return f"tabflow_{uuid.uuid4().hex}"
