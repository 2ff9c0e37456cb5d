"""Reversible line dedup: sharded cuckoo filters backed by exact reference
tables.

A line's key is the line without white space at its ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points that at least ``min_docs``
documents hold are common: all their lines go, except in the largest doc_id
that holds the key. Keys are kept as 128-bit hashes.

The index is exact: ``refs`` has a row for each key and document, ``counts``
each key's number of documents and largest doc_id. Over the common keys stand
cuckoo filters, one for each shard of the keys, which tell most lines apart
from common ones without a look into the tables. ``insert`` adds documents and
``delete`` takes them out again; both give a new index and leave the old one
as it is, and both update the filters key by key. All tables are Parquet in the
shared folder.

Skew: documents of a key are counted by partial aggregates, and lookups are
salted by document, in more parts where a shard holds a hot key, so a line that
a third of all documents hold meets no single task. A filter that finds no
free slot is built anew from the exact table.

Edge cases: a null or empty text is one empty line; a null doc_id is neither
counted nor changed; rows that share a doc_id are one document for counting
and each loses its own lines; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import documents, scratch_path, small_batches
from tabflow.llm.cuckoo import CuckooFilter, FilterFull, build

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 1 << 17
HOT_DOCS = 1 << 20  # of one key; a shard with a hotter one is probed by more tasks
_SALTS = 1 << 20
KEY = ["key_high", "key_low"]
_TRIM = b" \t\n\x0b\x0c\r"


def _line_key(line: bytes, min_chars: int) -> bytes | None:
    key = line.strip(_TRIM).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _hash(key: bytes) -> tuple[int, int]:
    from xxhash import xxh3_128_digest

    digest = xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, key_high, key_low: each key once per row of ``docs``."""

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, highs, lows = [], [], []
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                lines = set((text.as_py() or "").encode().split(b"\n"))
                found = {k for k in (_line_key(line, min_chars) for line in lines) if k is not None}
                for high, low in map(_hash, found):
                    ids.append(doc_id)
                    highs.append(high)
                    lows.append(low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (ids, highs, lows)], names=["doc_id", *KEY]
            )

    named = documents(docs).where(F.col("doc_id").isNotNull())
    return named.mapInArrow(keys, "doc_id long, key_high long, key_low long")


def _shard(shards: int):
    return F.pmod(F.col("key_high"), F.lit(shards))


def _streamed(frame: DataFrame, groups: list[str], order: list[str], fn: Callable, schema: str) -> DataFrame:
    """``fn`` over the partitions of ``frame``, in which the rows of a group
    stand together in order."""
    return frame.repartition(*groups).sortWithinPartitions(*groups, *order).mapInArrow(fn, schema)


def _runs(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batch cut where the column's value changes."""
    values = batch[column].to_numpy(zero_copy_only=False)
    starts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)] if len(values) else []
    for a, b in zip(starts, starts[1:], strict=False):
        yield int(values[a]), batch.slice(a, b - a)


def _halves(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch["key_high"].to_numpy(), batch["key_low"].to_numpy()


def _build_filters(common: DataFrame, shards: int) -> DataFrame:
    """shard, room, filter: a cuckoo filter of each shard's keys."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(shard: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            own = build(*(np.concatenate(x) for x in zip(*map(_halves, parts), strict=True)))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([own.room()], pa.int64()), pa.array([own.to_bytes()], pa.binary())],
                names=["shard", "room", "filter"],
            )

        shard, parts = None, []
        for batch in batches:
            for s, run in _runs(batch, "shard"):
                if s != shard and parts:
                    yield finished(shard, parts)
                    parts = []
                shard = s
                parts.append(run)
        if parts:
            yield finished(shard, parts)

    keyed = common.select(*KEY, _shard(shards).alias("shard"))
    return _streamed(keyed, ["shard"], KEY, made, "shard long, room long, filter binary")


def _update_filters(filters: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """``changes``: keys with ``add`` true (now common) or false (no longer).
    A shard whose keys found no free slot comes back with a null filter."""

    def changed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(shard: int, own: CuckooFilter, full: bool) -> pa.RecordBatch:
            data = None if full else own.to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([own.room()], pa.int64()), pa.array([data], pa.binary())],
                names=["shard", "room", "filter"],
            )

        shard, own, full = None, None, False
        for batch in batches:
            for kind_shard, run in _runs(batch, "shard"):
                if kind_shard != shard and own is not None:
                    yield finished(shard, own, full)
                    own = None
                shard = kind_shard
                for kind, rows in _runs(run, "kind"):
                    if kind == 0:
                        own, full = CuckooFilter.from_bytes(rows["filter"][0].as_py()), False
                    elif full:
                        continue
                    elif kind == 1:
                        own.delete(*_halves(rows))
                    else:
                        try:
                            own.insert(*_halves(rows))
                        except FilterFull:
                            full = True
        if own is not None:
            yield finished(shard, own, full)

    kind = F.when(F.col("add"), 2).otherwise(1)
    keyed = changes.select(_shard(shards).alias("shard"), kind.alias("kind"), *KEY)
    rows = filters.select("shard", F.lit(0).alias("kind"), "filter").unionByName(keyed, allowMissingColumns=True)
    return _streamed(rows, ["shard"], ["kind", *KEY], changed, "shard long, room long, filter binary")


@dataclass(frozen=True)
class LineIndex:
    """One state of the index; its tables never change."""

    spark: SparkSession
    segments: tuple[str, ...]
    counts_path: str
    filters_path: str
    shards: int
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS

    @property
    def refs(self) -> DataFrame:
        return self.spark.read.schema("doc_id long, key_high long, key_low long").parquet(*self.segments)

    @property
    def counts(self) -> DataFrame:
        schema = "key_high long, key_low long, n_docs long, last_doc long"
        return self.spark.read.schema(schema).parquet(self.counts_path)

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.schema("shard long, room long, filter binary").parquet(self.filters_path)

    @property
    def common(self) -> DataFrame:
        return self.counts.where(F.col("n_docs") >= self.min_docs)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with these documents too; keys that a document already
        holds are not counted again."""
        segment = scratch_path(self.spark, "line-refs")
        fresh = line_keys(docs, self.min_chars).distinct().join(self.refs, ["doc_id", *KEY], "left_anti")
        fresh.write.parquet(segment)
        added = _count(self.spark.read.schema(self.refs.schema).parquet(segment))
        before = F.coalesce("b.n_docs", F.lit(0).cast("long"))
        merged = (
            self.counts.alias("b")
            .join(added.alias("a"), KEY, "full")
            .select(
                *KEY,
                (before + F.coalesce("a.n_docs", F.lit(0).cast("long"))).alias("n_docs"),
                F.greatest("b.last_doc", "a.last_doc").alias("last_doc"),
            )
        )
        return self._with((*self.segments, segment), merged)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents whose ids ``doc_ids.doc_id`` names."""
        segment = scratch_path(self.spark, "line-refs")
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        self.refs.join(ids, "doc_id", "left_anti").write.parquet(segment)
        touched = self.refs.join(ids, "doc_id", "left_semi").select(*KEY).distinct()
        left = self.spark.read.schema(self.refs.schema).parquet(segment)
        recounted = _count(left.join(touched, KEY, "left_semi"))
        merged = self.counts.join(touched, KEY, "left_anti").unionByName(recounted)
        return self._with((segment,), merged)

    def _with(self, segments: tuple[str, ...], counts: DataFrame) -> LineIndex:
        counts_path, filters_path = scratch_path(self.spark, "line-counts"), scratch_path(self.spark, "line-filters")
        counts.write.parquet(counts_path)
        after = replace(self, segments=segments, counts_path=counts_path)
        full = (
            after.common.groupBy(_shard(self.shards).alias("shard"))
            .agg(F.count(F.lit(1)).alias("n"))
            .join(self.filters.select("shard", "room"), "shard", "left")
            .where(F.col("room").isNull() | (F.col("n") > F.col("room")))
        )
        if full.isEmpty():
            is_common = lambda side: F.coalesce(F.col(f"{side}.n_docs") >= self.min_docs, F.lit(False))
            both = self.counts.alias("b").join(after.counts.alias("a"), KEY, "full")
            changes = both.where(is_common("a") != is_common("b")).select(*KEY, is_common("a").alias("add"))
            filters, shards = _update_filters(self.filters, changes, self.shards), self.shards
        else:  # a shard outgrew its filter: deal the keys anew
            shards = _shards(after.common)
            filters = _build_filters(after.common, shards)
        filters.write.parquet(filters_path)
        after = replace(after, filters_path=filters_path, shards=shards)
        lost = after.filters.where("filter is null").select(F.col("shard").alias("s"))
        if not lost.isEmpty():  # keys can crowd two buckets below the filter's load: build those shards anew
            again = after.common.join(lost, _shard(shards) == F.col("s"), "left_semi")
            rebuilt = scratch_path(self.spark, "line-filters")
            after.filters.where("filter is not null").unionByName(_build_filters(again, shards)).write.parquet(rebuilt)
            after = replace(after, filters_path=rebuilt)
        return after

    def drops(self, docs: DataFrame, hot_docs: int = HOT_DOCS) -> DataFrame:
        """doc_id, key_high, key_low of the lines that go: filter first, then
        the exact table for what the filter lets through. A shard's lines are
        dealt to several tasks by document; to more where one of its keys is
        hot, so a task meets about ``hot_docs`` lines of a key at most."""
        spread = max(1, math.ceil(int(self.spark.conf.get("spark.sql.shuffle.partitions")) / self.shards))
        # Few rows: a shard is named for every hot_docs lines at most.
        hot = self.common.where(F.col("n_docs") > hot_docs * spread)
        hot = hot.groupBy(_shard(self.shards).alias("shard")).agg(F.ceil(F.max("n_docs") / hot_docs).alias("more"))
        salts = F.least(F.coalesce("more", F.lit(spread)), F.lit(_SALTS))
        names = ["doc_id", *KEY]

        def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group, own = None, None
            for batch in batches:
                for g, run in _runs(batch, "group"):
                    if g != group:
                        group, own = g, None
                    for kind, rows in _runs(run, "kind"):
                        if kind == 0:
                            own = CuckooFilter.from_bytes(rows["filter"][0].as_py())
                        elif own is not None:  # a shard without common keys has no filter
                            hit = own.contains(*_halves(rows))
                            yield pa.RecordBatch.from_arrays([rows[n].filter(pa.array(hit)) for n in names], names=names)

        lines = line_keys(docs, self.min_chars).withColumn("shard", _shard(self.shards)).join(hot, "shard", "left")
        lines = lines.select(
            (F.col("shard") * _SALTS + F.pmod(F.xxhash64("doc_id"), salts)).alias("group"), F.lit(1).alias("kind"), *names
        )
        every_salt = F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1))
        filters = self.filters.join(hot, "shard", "left").select("shard", "filter", every_salt.alias("salt"))
        filters = filters.select((F.col("shard") * _SALTS + F.col("salt")).alias("group"), F.lit(0).alias("kind"), "filter")
        rows = lines.unionByName(filters, allowMissingColumns=True)
        passed = _streamed(rows, ["group"], ["kind"], probe, "doc_id long, key_high long, key_low long")
        exact = self.common.select(*KEY, "last_doc")
        return passed.join(exact, KEY).where(F.col("doc_id") != F.col("last_doc")).select(*names)


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))


def _shards(common: DataFrame) -> int:
    return max(1, math.ceil(common.count() / SHARD_KEYS))


def build_index(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
    """Index all documents."""
    spark = docs.sparkSession
    small_batches(spark)
    refs, counts, filters = (scratch_path(spark, f"line-{n}") for n in ("refs", "counts", "filters"))
    line_keys(docs, min_chars).distinct().write.parquet(refs)
    index = LineIndex(spark, (refs,), counts, filters, 1, min_chars, min_docs)
    _count(index.refs).write.parquet(counts)
    index = replace(index, shards=_shards(index.common))
    _build_filters(index.common, index.shards).write.parquet(filters)
    return index


def dedup_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its dropped lines (a null text
    becomes empty), and _n_lines (before) and _n_dropped, which replace input
    columns of these names."""
    small_batches(docs.sparkSession)
    own = {"text", "_n_lines", "_n_dropped", "_drops"}
    carried = [c for c in docs.columns if c not in own]
    gone = index.drops(docs).groupBy("doc_id").agg(F.collect_set("key_high").alias("_drops"))
    joined = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in own - {"text"}]).join(gone, "doc_id", "left")
    min_chars = index.min_chars

    def dropped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, lost = [], [], []
            for text, drops in zip(batch["text"], batch["_drops"].to_pylist(), strict=True):
                lines = (text.as_py() or "").encode().split(b"\n")
                kept = lines
                if drops:
                    gone = set(drops)
                    kept = [x for x in lines if (k := _line_key(x, min_chars)) is None or _hash(k)[0] not in gone]
                texts.append(b"\n".join(kept).decode())
                before.append(len(lines))
                lost.append(len(lines) - len(kept))
            columns = [batch[c] for c in carried]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(lost, pa.int64())],
                names=[*carried, "text", "_n_lines", "_n_dropped"],
            )

    schema = joined.select(*[f"`{c}`" for c in carried], F.col("text").cast("string")).schema
    schema = schema.add("_n_lines", "long").add("_n_dropped", "long")
    return joined.mapInArrow(dropped, schema)
