"""MinHash near-dedup: universal hash minima with banding, signature
verification, links confirmed on full shingle sets, and connected components.

1. Each text becomes its set of word shingles (64-bit hashes) and 128 minima.
   Equal sets collapse to one representative, the smallest doc_id.
2. Bands of four minima are bucket keys. In each bucket every member meets the
   pivot: the member that shares most buckets with others, which in a group of
   edited copies is the text they were made from. These candidates grow with
   the members, not with their square.
3. Candidates pass if their signatures agree about as much as the threshold
   asks, and are then confirmed on the full sets, computed from the texts.
4. Components of these links. In buckets that still hold several components
   the members of different ones meet each other too (block by block,
   signatures first, then full sets), so no link is lost for want of a pivot;
   then the final components.

Two sets at the threshold share no band with probability below 1e-7 (bands of
4 rows, 32 bands), and the signature test is five standard deviations wide.

Edge cases: null, empty and blank texts have no shingles and link with
nothing; a text with fewer words than a shingle is one shingle; a row with a
null doc_id is linked with nothing, has a null component and is kept; rows
that share a doc_id are one node, which has the links of each; empty tables
give empty results. Whole texts are used, whatever their length.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import documents, materialize, small_batches
from tabflow.llm.components import components
from tabflow.llm.order import ordered

BLOCK_MEMBERS = 512  # of a bucket; one task compares two blocks at most at a time
HUB_TEXTS = 256  # compared with one copy of a hub's set
_WORDS_CACHED = 100_000  # by a Python worker, which lives on after its task
_CACHED_BYTES = 64  # of a word; longer ones are hashed each time
_STEP = 512  # shingles hashed at a time, to stay in the processor's cache
_ODD = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio as a 64-bit fraction


@dataclass(frozen=True)
class Similarity:
    """Texts are near if 100 * shared shingles >= percent * all shingles."""

    shingle_words: int = 5
    percent: int = 80
    bands: int = 32
    band_rows: int = 4
    seed: int = 1

    @property
    def hashes(self) -> int:
        return self.bands * self.band_rows

    @property
    def least_agreement(self) -> int:
        """Of the signatures: the threshold less five standard deviations."""
        share = self.percent / 100
        return math.floor(self.hashes * share - 5 * math.sqrt(self.hashes * share * (1 - share)))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        value = xxh3_64_intdigest(word)
        if len(word) <= _CACHED_BYTES:
            if len(self) >= _WORDS_CACHED:
                self.clear()
            self[word] = value
        return value


_word_hashes = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles. A-Z are
    lower-cased; words are split at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(_word_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = _mix(out + hashed[k : k + n])
    return np.unique(out)


class Minima:
    """Strongly universal hashes (multiply, add, shift) and their minima."""

    def __init__(self, similarity: Similarity):
        rng = np.random.default_rng(similarity.seed)
        self._factor, self._shift = rng.integers(0, 2**64, size=(2, 1, similarity.hashes), dtype=np.uint64)

    def signature(self, shingle_set: np.ndarray) -> np.ndarray:
        low = (shingle_set >> np.uint64(32))[:, None]
        least = np.full(self._factor.shape[1], 2**32 - 1, dtype=np.uint64)
        for i in range(0, len(low), _STEP):
            hashed = low[i : i + _STEP] * self._factor
            hashed += self._shift
            hashed >>= np.uint64(32)
            np.minimum(least, hashed.min(axis=0), out=least)
        return least.astype("<u4")


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names=names)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, width)


def signatures(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set (set_high, set_low)
    and the signature of every row."""
    names = ["doc_id", "n_shingles", "set_high", "set_low", "signature"]

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        minima = Minima(similarity)
        for batch in batches:
            sizes, high, low, signed = [], [], [], []
            for text in batch[1]:
                own = shingles(text.as_py(), similarity.shingle_words)
                digest = np.frombuffer(xxh3_128_digest(own.tobytes()), dtype="<i8")
                sizes.append(len(own))
                high.append(digest[0])
                low.append(digest[1])
                signed.append(minima.signature(own).tobytes())
            yield _batch(names, batch[0], sizes, high, low, pa.array(signed, pa.binary()))

    schema = "doc_id long, n_shingles long, set_high long, set_low long, signature binary"
    return documents(docs).mapInArrow(sign, schema)


def _band_keys(sets: DataFrame, similarity: Similarity) -> DataFrame:
    """key, band, id: a row for each band of each set."""

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            minima = _matrix(batch["signature"], similarity.hashes).astype(np.uint64)
            rows = minima.reshape(-1, similarity.bands, similarity.band_rows)
            out = np.broadcast_to(np.arange(similarity.bands, dtype=np.uint64), rows.shape[:2])
            for k in range(similarity.band_rows):
                out = _mix(out + rows[:, :, k])
            ids = np.repeat(batch["id"].to_numpy(), similarity.bands)
            bands = np.tile(np.arange(similarity.bands), batch.num_rows)
            yield _batch(["key", "band", "id"], out.reshape(-1).view(np.int64), bands, ids)

    return sets.select("id", "signature").mapInArrow(keys, "key long, band long, id long")


def _agree(pairs: DataFrame, sets: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures may reach the threshold."""
    sides = [sets.select(*[F.col(c).alias(f"{s}_{c}") for c in ("id", "n_shingles", "signature")]) for s in "ab"]
    sized = (
        pairs.join(sides[0], F.col("a") == F.col("a_id"))
        .join(sides[1], F.col("b") == F.col("b_id"))
        .where(100 * F.least("a_n_shingles", "b_n_shingles") >= similarity.percent * F.greatest("a_n_shingles", "b_n_shingles"))
    )

    def agreeing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = _matrix(batch[2], similarity.hashes) == _matrix(batch[3], similarity.hashes)
                near = pa.array(same.sum(axis=1) >= similarity.least_agreement)
                yield _batch(["a", "b"], batch[0].filter(near), batch[1].filter(near))

    return sized.select("a", "b", "a_signature", "b_signature").mapInArrow(agreeing, "a long, b long").distinct()


def _confirm(pairs: DataFrame, docs: DataFrame, similarity: Similarity) -> DataFrame:
    """u, v: the pairs (a, b) that are near by their full sets. Each b is a hub;
    its text meets those of its a's in groups of about HUB_TEXTS, so neither a
    hub nor its set in memory grows with its pairs."""
    pairs = materialize(pairs, "pairs")
    groups = materialize(
        pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / HUB_TEXTS).cast("long").alias("groups")), "hubs"
    )
    spokes = pairs.join(groups, "b").select(
        F.col("a").alias("id"), F.col("b").alias("hub"), F.pmod(F.xxhash64("a"), "groups").alias("group"), F.lit(1).alias("kind")
    )
    hubs = groups.select(
        F.col("b").alias("id"),
        F.col("b").alias("hub"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"),
        F.lit(0).alias("kind"),
    )
    size, percent = similarity.shingle_words, similarity.percent

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sets = None, []
        for batch in batches:
            u, v = [], []
            ids, hub_ids, group_ids, kinds = (batch[n].to_pylist() for n in ("id", "hub", "group", "kind"))
            for id_, hub, group, kind, text in zip(ids, hub_ids, group_ids, kinds, batch["text"], strict=True):
                if at != (hub, group):
                    at, sets = (hub, group), []
                own = shingles(text.as_py(), size)
                if kind == 0:
                    sets.append(own)
                    continue
                for other in sets:
                    place = np.searchsorted(other, own)
                    place[place == len(other)] = 0
                    shared = int((other[place] == own).sum())
                    if 100 * shared >= percent * (len(own) + len(other) - shared):
                        u.append(id_)
                        v.append(hub)
                        break
            yield _batch(["u", "v"], u, v)

    texts = documents(docs)
    return (
        spokes.unionByName(hubs)
        .join(texts, F.col("id") == F.col("doc_id"))
        .select("id", "hub", "group", "kind", "text")
        .repartition("hub", "group")
        .sortWithinPartitions("hub", "group", "kind")
        .mapInArrow(near, "u long, v long")
    )


_UNIT = ["key", "i", "j"]
_MEMBER = ["band", "own", "label", "id"]


class _Pairs:
    """The pairs of one unit that sizes and signatures let through: members
    with different labels, of different blocks if the unit has two. A pair that
    shares several buckets counts in its first band only."""

    def __init__(self, table: pa.Table, similarity: Similarity):
        self.i, self.j, self.band, self.own, self.label, self.id, self.size = (
            table[n].to_numpy() for n in (*_UNIT[1:], *_MEMBER, "n_shingles")
        )
        self._signed = _matrix(table["signature"].combine_chunks(), similarity.hashes)
        self._similarity = similarity

    def of(self, k: int) -> np.ndarray:
        """The later members that member ``k`` may be near to."""
        later, near = slice(k + 1, None), self._similarity
        small, large = np.minimum(self.size[later], self.size[k]), np.maximum(self.size[later], self.size[k])
        fits = (self.label[later] != self.label[k]) & (100 * small >= near.percent * large)
        if self.i[0] != self.j[0]:
            fits &= self.own[later] != self.own[k]  # pairs inside a block are that block's own unit
        found = np.flatnonzero(fits) + k + 1
        same = self._signed[found] == self._signed[k]
        shared = same.reshape(-1, near.bands, near.band_rows).all(axis=2)
        return found[(same.sum(axis=1) >= near.least_agreement) & (shared.argmax(axis=1) == self.band[0])]


def _by_unit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each unit, whose rows stand together."""
    at, rows = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = np.stack([batch[n].to_numpy() for n in _UNIT], axis=1)
        starts = [0, *(np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1).tolist(), len(unit)]
        for x, y in zip(starts, starts[1:], strict=False):
            if at != tuple(unit[x]) and rows:
                yield pa.Table.from_batches(rows)
                rows = []
            at = tuple(unit[x])
            rows.append(batch.slice(x, y - x))
    if rows:
        yield pa.Table.from_batches(rows)


def _across(members: DataFrame, sets: DataFrame, docs: DataFrame, similarity: Similarity) -> DataFrame:
    """u, v: confirmed links between members (key, band, id, n, label) of a
    bucket with different labels. A bucket is cut in blocks, and each pair of
    blocks is a unit of work. A first pass over the signatures finds the
    members with any possible pair; only their texts go to the units, once a
    unit, so no row is made for a pair unless it is a link."""
    cut = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK_MEMBERS).cast("long"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("id"), "blocks"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    units = cut.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).select(*_UNIT, *_MEMBER)
    signed = sets.select("id", "n_shingles", "signature")
    size, percent = similarity.shingle_words, similarity.percent

    def possible(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_unit(batches):
            pairs = _Pairs(table, similarity)
            involved = np.zeros(table.num_rows, dtype=bool)
            for k in range(table.num_rows - 1):
                found = pairs.of(k)
                involved[found] = True
                involved[k] |= len(found) > 0
            yield from table.select([*_UNIT, *_MEMBER]).filter(pa.array(involved)).to_batches()

    def confirmed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_unit(batches):
            pairs = _Pairs(table, similarity)
            own = [shingles(text.as_py(), size) for text in table["text"]]
            u, v, merged = [], [], {}

            def root(label: int, merged: dict = merged) -> int:
                while label in merged:
                    label = merged[label]
                return label

            for k in range(table.num_rows - 1):
                for m in pairs.of(k).tolist():
                    a, b = root(int(pairs.label[k])), root(int(pairs.label[m]))
                    if a == b:
                        continue  # this unit has linked their labels already
                    shared = len(np.intersect1d(own[k], own[m], assume_unique=True))
                    if 100 * shared >= percent * (len(own[k]) + len(own[m]) - shared):
                        u.append(int(pairs.id[k]))
                        v.append(int(pairs.id[m]))
                        merged[max(a, b)] = min(a, b)
            yield _batch(["u", "v"], u, v)

    def in_units(rows: DataFrame) -> DataFrame:
        return rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "id")

    found = in_units(units.join(signed, "id").select(*_UNIT, *_MEMBER, "n_shingles", "signature")).mapInArrow(
        possible, ", ".join(f"{c} long" for c in (*_UNIT, *_MEMBER))
    )
    found = materialize(found, "units")
    texts = documents(docs)
    complete = found.join(signed, "id").join(texts, F.col("id") == F.col("doc_id"))
    return in_units(complete.select(*_UNIT, *_MEMBER, "n_shingles", "signature", "text")).mapInArrow(
        confirmed, "u long, v long"
    )


def near_links(sets: DataFrame, docs: DataFrame, similarity: Similarity) -> DataFrame:
    """u, v: confirmed links that connect all near sets. ``sets``: id,
    n_shingles and signature of the distinct sets; ``docs``: their texts."""
    keys = _band_keys(sets, similarity)
    # Written tables are plain join sides, so Spark can split the rows of a hot bucket.
    shared = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    members = materialize(keys.join(shared, "key"), "buckets")
    mass = materialize(members.groupBy("id").agg(F.sum("n").alias("mass")), "mass")
    pivots = members.join(mass, "id").groupBy("key").agg(F.max_by("id", F.struct("mass", -F.col("id"))).alias("pivot"))
    pivoted = materialize(members.join(materialize(pivots, "pivots"), "key").where("id != pivot"), "buckets")
    stars = pivoted.select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    links = materialize(_confirm(_agree(stars, sets, similarity), docs, similarity), "links")

    labels = components(links)
    labelled = pivoted.join(labels, F.col("id") == F.col("node"), "left").select(
        "key", "band", "id", "n", F.coalesce("component", "id").alias("label")
    )
    labelled = materialize(labelled, "buckets")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    rest = labelled.join(materialize(mixed.select("key"), "mixed"), "key")
    return links.unionByName(_across(rest, sets, docs, similarity))


def near_duplicates(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links, itself included) and kept."""
    small_batches(docs.sparkSession)
    signed = materialize(signatures(docs, similarity), "signatures")
    group = ["set_high", "set_low"]
    nodes = signed.where("n_shingles > 0 and doc_id is not null")
    sets = materialize(
        nodes.groupBy(*group, "n_shingles").agg(F.min("doc_id").alias("id"), F.any_value("signature").alias("signature")),
        "sets",
    )
    found = components(near_links(sets, docs, similarity))
    of_set = sets.join(found, F.col("id") == F.col("node"), "left").select(
        *group, F.coalesce("component", "id").alias("component")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        signed.select("doc_id", "n_shingles", *group)
        .join(of_set, group, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs`` less all of a component but one, that of its
    smallest doc_id. It decides row by row: rows that share a doc_id are judged
    by their own texts, and rows without one count as the largest. Of equal rows
    of a component one stays; rows without text or words all stay."""
    unnamed = docs.groupBy(F.col("doc_id").cast("long").alias("id")).count().where("id IS NULL OR count > 1")
    if unnamed.isEmpty():  # the usual case: the doc_id names the row
        drop = materialize(near_duplicates(docs, similarity).where("NOT kept").select("doc_id"), "near")
        return docs.join(drop, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    rows = _numbered(docs)
    texts = rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"))
    drop = near_duplicates(texts, similarity).where("NOT kept").select(F.col("doc_id").alias("number"))
    return rows.join(materialize(drop, "near"), "number", "left_anti").select("row.*")


def _numbered(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as ``row`` with its ``number`` in the order of
    doc_id, null last; written, so that later readers see the same numbers."""
    doc_id = F.col("doc_id").cast("long")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keys = [F.lit(0).alias("_all"), doc_id.isNull().alias("_unnamed"), doc_id.alias("_id"), F.sha2("text", 256).alias("_digest")]
    placed = ordered(materialize(docs.select(whole, *keys), "unnumbered"), ["_all"], ["_unnamed", "_id", "_digest"])
    return materialize(placed.rows().select(F.col("_position").alias("number"), "row"), "numbered")
