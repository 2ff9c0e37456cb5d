"""Merkle manifest of a dataset: a hash tree over the rows of each group and
over the groups, with a proof for each row.

A leaf is the SHA-256 of a row's fields. Rows of a group stand in a given
order; every ``arity`` consecutive nodes (the last run may be shorter, even one
node) become the hash of their digests as lowercase hex, level by level, until
one is left: the group's subroot. The subroots, in the order of groups, make
the root in the same way. A lone leaf is its group's subroot.

Each level is one equijoin of the nodes with themselves on computed sibling
indices: a node asks for slot + 1, slot + 2, ... modulo the arity in its run.
The row in slot zero then emits the parent. Keys are node indices, so a group
that holds most rows is no hot key. Paths are handed down from the root, each
node's to its at most ``arity`` children, so no join key has more rows than that.

Edge cases: null fields have their own mark, apart from every value; null
groups and null order values come first; rows that are equal in all of them
have equal leaves and take neighbouring places; an empty table has no root and
gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import materialize
from tabflow.llm.order import ordered

ARITY = 8
KEY = ["g", "i"]


def field(value: Column) -> Column:
    """A value as it enters a leaf: UTF-8 byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields in a row."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined(run: Column, keep) -> Column:
    """The digests of a run's (slot, digest) entries that ``keep`` takes, in a row."""
    taken = F.transform(F.filter(run, keep), lambda x: _hex(x["digest"]))
    return F.unhex(F.array_join(taken, ""))


def _level(nodes: DataFrame, arity: int) -> DataFrame:
    """g, i, n, digest of the nodes that have a parent, and the digests before
    and after them in their run."""
    slot = F.pmod("i", F.lit(arity))
    asked = nodes.select("g", "i", "n", F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("offset"))
    other = F.col("i") - slot + F.pmod(slot + F.col("offset"), F.lit(arity))
    asked = asked.withColumn("other", other).where("other < n").drop("offset")
    found = nodes.select("g", F.col("i").alias("other"), "digest")
    siblings = asked.join(found, ["g", "other"]).withColumn("own", F.lit(False))
    own = nodes.select("g", F.col("i").alias("other"), "i", "n", "digest", F.lit(True).alias("own"))
    entry = F.struct(F.pmod("other", F.lit(arity)).alias("slot"), "digest", "own")
    runs = siblings.unionByName(own).groupBy("g", "i", "n").agg(F.array_sort(F.collect_list(entry)).alias("run"))
    return runs.select(
        "g",
        "i",
        "n",
        F.filter("run", lambda x: x["own"])[0]["digest"].alias("digest"),
        _joined(F.col("run"), lambda x: x["slot"] < slot).alias("before"),
        _joined(F.col("run"), lambda x: x["slot"] > slot).alias("after"),
    )


def _parents(level: DataFrame, arity: int) -> DataFrame:
    first = level.where(F.pmod("i", F.lit(arity)) == 0)
    return first.select(
        "g",
        F.expr(f"i div {arity}").alias("i"),
        F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
        F.unhex(F.sha2(_hex(F.concat("before", "digest", "after")), 256)).alias("digest"),
    )


@dataclass(frozen=True)
class _Trees:
    """All levels of the trees of all groups, leaves first, and each group's
    top with the height it stands at."""

    levels: list[DataFrame]
    tops: DataFrame
    arity: int

    def paths(self, above: DataFrame) -> DataFrame:
        """g, i, path, subroot of every leaf. ``above``: g, path, subroot, what
        each group's top gets."""
        tops = materialize(self.tops.join(above, "g"), "manifest-tops")

        def at(height: int) -> DataFrame:
            return tops.where(F.col("height") == height).select("g", F.lit(0).cast("long").alias("i"), "path", "subroot")

        below = at(len(self.levels))
        for height in reversed(range(len(self.levels))):
            parent = below.select("g", F.col("i").alias("parent"), F.col("path").alias("rest"), "subroot")
            entry = F.array(F.struct("before", "after"))
            own = self.levels[height].withColumn("parent", F.expr(f"i div {self.arity}"))
            below = own.join(parent, ["g", "parent"]).select("g", "i", F.concat(entry, "rest").alias("path"), "subroot")
            below = below.unionByName(at(height))
        return below


def _trees(leaves: DataFrame, arity: int) -> _Trees:
    """``leaves``: a table of g, i (from 0 in g), n (leaves of g) and digest."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, tops, nodes = [], [], leaves
    while True:
        tops.append(nodes.where("n = 1").select("g", "digest", F.lit(len(levels)).alias("height")))
        if most <= 1:
            break
        levels.append(materialize(_level(nodes.where("n > 1"), arity), "manifest-level"))
        nodes = materialize(_parents(levels[-1], arity), "manifest-nodes")
        most = -(-most // arity)
    every = tops[0]
    for more in tops[1:]:
        every = every.unionByName(more)
    return _Trees(levels, every, arity)


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str = "leaf", arity: int = ARITY) -> DataFrame:
    """``rows`` with subroot, root (lowercase hex) and path: an entry for each
    level from the leaf to the root, with the digests ``before`` and ``after``
    the node in its run. ``rows`` has a column ``leaf`` and none named as those
    three or with a leading underscore."""
    table = materialize(rows, "manifest-rows")
    places = materialize(ordered(table, [group], [*order, leaf]).rows(), "manifest-places")
    node = [F.col("_group").alias("g"), F.col("_position").alias("i")]
    leaves = places.select(*node, F.col("_group_rows").alias("n"), F.unhex(F.col(f"`{leaf}`")).alias("digest"))
    trees = _trees(leaves, arity)
    subroots = materialize(trees.tops.select("g", "digest"), "manifest-subroots")
    count = subroots.count()
    top = _trees(
        subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(count).cast("long").alias("n"), "digest"),
        arity,
    )
    found = top.tops.first()
    root = found["digest"].hex() if found else None
    no_entry = F.array().cast("array<struct<before:binary,after:binary>>")
    start = top.tops.select("g", no_entry.alias("path"), F.lit(None).cast("binary").alias("subroot"))
    up = top.paths(start).select(F.col("i").alias("g"), "path").join(subroots, "g")
    paths = trees.paths(materialize(up.select("g", "path", F.col("digest").alias("subroot")), "manifest-top"))
    carried = [F.col(f"`{c}`") for c in rows.columns]
    placed = places.select(F.struct(*carried).alias("row"), *node).join(paths, KEY)
    own = [F.col("row").getField(c).alias(c) for c in rows.columns]
    return placed.select(*own, _hex(F.col("subroot")).alias("subroot"), F.lit(root).alias("root"), "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda own, at: F.sha2(F.concat(_hex(at["before"]), own, _hex(at["after"])), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on the way, level by level, left to right."""
    siblings = F.transform(path, lambda at: _hex(F.concat(at["before"], at["after"])))
    return F.sha2(F.array_join(siblings, ""), 256)
