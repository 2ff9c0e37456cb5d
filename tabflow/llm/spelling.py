"""Spelling variant grouping: words one edit apart, found by walking a trie as
a relation.

The trie of the vocabulary is a distributed edge table (node, symbol, child),
sorted by level; a node is named by its prefix, so no two nodes share a name.
Each word enters the trie where its first half ends, and the frontier of
(word, position, node, edits) states is joined with the edges of one level
after the other. A state without edits follows its own letter, may replace it
by another child's letter, or drops it; a state with one edit follows its own
letters only. One that ends at a word with all letters used is a neighbour.
Edits in the first half are found in the same way from the end: a second trie
holds the reversed words. As a replacement or an insertion is the same pair
seen from the other word, only replacements by a larger letter and deletions
(of a run of equal letters, the last one) are walked, and pairs are then given
both ways. Edges carry the symbols that follow their child, so a state is only
made where its next letter exists.

Words above ``TRIE_CHARS`` code points, which would need a level for every
letter, take another exact way: hashes of the word without each of its
letters, made by prefix sums, are joined, and every hit is compared letter by
letter.

Skew: words are counted by partial aggregates. A node's edges are at most the
alphabet, and a hot node's states can be split, as they are read from a table.

Edge cases: null and empty texts have no words; a null doc_id counts as empty
text in the hash of ``corrupted_words``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import documents, materialize, scratch_path

# Letters of a word, and the letters that are lower-cased.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 7
MIN_COUNT = 2
FORM_FACTOR = 10
CORRUPT_ONE_IN = 31

TRIE_CHARS = 32
_MODULUS, _BASES = (1 << 31) - 1, (1_000_003, 998_244_353)  # products stay below 2**63
_ROWS_PER_BATCH = 1 << 16
_END = "$"  # among the symbols after a node: a word ends here; no letter
STATE = ["backward", "word", "pos", "node", "edits", "ends"]


def words_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, word: every maximal run of at least ``min_chars`` letters, A-Z lower-cased."""
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{max(1, min_chars)},}}"), F.lit(0))
    found = documents(docs).select("doc_id", F.explode(runs).alias("word"))
    return found.withColumn("word", F.translate("word", UPPER, LOWER))


def corrupted_words(docs: DataFrame, min_chars: int = MIN_CHARS, one_in: int = CORRUPT_ONE_IN) -> DataFrame:
    """As ``words_of``, but one run in ``one_in``, chosen with its place by the
    crc32 of ``<doc_id>:<run>``, loses a letter; at least ``min_chars`` stay."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = F.pmod("h", F.length("word")).cast("int")
    less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    hashed = words_of(docs, min_chars).withColumn("h", h)
    word = F.when(F.pmod("h", F.lit(one_in)) == 0, less).otherwise(F.col("word"))
    return hashed.select("doc_id", word.alias("word")).where(F.length("word") >= min_chars)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words that occur ``min_count`` times or more."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _char(text: Column | str, at: Column) -> Column:
    """The code point at a place from 0; empty text behind the end."""
    return F.substring(text, at + 1, F.lit(1))


def _half(size: Column) -> Column:
    """Letters of the first half; tiny words are walked from the start."""
    return F.when(size < 4, 0).otherwise(F.floor(size / 2)).cast("int")


def _trie(words: DataFrame) -> DataFrame:
    """Edges below the nodes of both tries: backward, node, depth (letters of
    node), symbol, child, ends (a word ends at child), after (the symbols after
    child)."""
    both = words.select("word", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward"))
    both = both.select("backward", F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")).alias("word"))
    size = F.length("word")
    # Half a word is walked, so the nodes above the shortest half have no use.
    cut = both.select("backward", "word", F.explode(F.sequence(_half(size), size)).alias("depth"))
    after = F.when(F.col("depth") == size, F.lit(_END)).otherwise(_char("word", F.col("depth")))
    steps = cut.select("backward", F.substring("word", F.lit(1), F.col("depth")).alias("child"), after.alias("symbol"))
    nodes = steps.groupBy("backward", "child").agg(F.concat_ws("", F.collect_set("symbol")).alias("after"))
    depth = F.length("child") - 1
    return nodes.select(
        "backward",
        F.substring("child", F.lit(1), depth).alias("node"),
        depth.alias("depth"),
        _char("child", depth).alias("symbol"),
        "child",
        F.contains("after", F.lit(_END)).alias("ends"),
        "after",
    )


def _entrants(words: DataFrame) -> DataFrame:
    """A state for each word and direction, where its first half ends: the
    letters before it are kept as they are. Forward and backward halves make
    up the whole word."""
    half = _half(F.length("word"))
    forward = words.select(F.lit(False).alias("backward"), "word", half.alias("pos"))
    backward = words.select(F.lit(True).alias("backward"), F.reverse("word").alias("word"), (F.length("word") - half).alias("pos"))
    return forward.unionByName(backward).select(
        "backward",
        "word",
        "pos",
        F.substring("word", F.lit(1), F.col("pos")).alias("node"),
        F.lit(0).alias("edits"),
        F.lit(False).alias("ends"),
    )


def _with_deletions(states: DataFrame) -> DataFrame:
    """The states, and for each without edits the one that drops its next
    letter (of equal letters in a row, the last)."""
    here, then = _char("word", F.col("pos")), _char("word", F.col("pos") + 1)
    drops = (F.col("edits") == 0) & (F.col("pos") < F.length("word")) & (here != then)
    variants = F.when(drops, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    every = states.withColumn("dropped", F.explode(variants))
    return every.withColumns({"pos": F.col("pos") + F.col("dropped"), "edits": F.col("edits") + F.col("dropped")}).drop("dropped")


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level further down."""
    own = _char("word", F.col("pos"))
    unused = F.col("pos") < F.length("word")
    follows = F.col("symbol") == own
    replaces = (F.col("edits") == 0) & (F.col("symbol") > own)
    edits = F.col("edits") + F.when(follows, 0).otherwise(1)
    # After the step: the next letter, or the end of a word, must stand below the child.
    following = _char("word", F.col("pos") + 1)
    goes_on = F.when(following == "", F.contains("after", F.lit(_END))).otherwise(F.contains("after", following))
    # A state without edits goes on in any case, as its next letter may be the one that is edited.
    down = states.where(unused).join(edges.drop("ends"), ["backward", "node"])
    down = down.where(follows | replaces).where((edits == 0) | goes_on)
    return down.select(
        "backward",
        "word",
        (F.col("pos") + 1).alias("pos"),
        F.col("child").alias("node"),
        edits.alias("edits"),
        F.contains("after", F.lit(_END)).alias("ends"),
    )


def _done() -> Column:
    return (F.col("edits") == 1) & F.col("ends") & (F.col("pos") == F.length("word"))


def trie_neighbours(words: DataFrame, trie_chars: int = TRIE_CHARS) -> DataFrame:
    """word, near, each pair at least once in one direction. ``words``: a table
    of distinct words of at most ``trie_chars`` code points, which bound the
    rounds. A round's states are a written table, so a lost executor costs one
    round at most."""
    spark = words.sparkSession
    # In order of depth, so that a round reads its own level.
    entering = materialize(_entrants(words).withColumn("depth", F.length("node")).sortWithinPartitions("depth"), "trie-words")
    edges = materialize(_trie(words).sortWithinPartitions("depth"), "trie-edges")
    depths = entering.agg(F.min("depth"), F.max("depth")).first()
    schema = entering.select(*STATE).schema
    if depths[0] is None:
        return spark.createDataFrame([], "word string, near string")
    frontier, paths = spark.createDataFrame([], schema), []
    for depth in range(depths[0], trie_chars + 1):
        open_states = frontier.where(F.col("pos") < F.length("word"))
        if depth > depths[1] and open_states.isEmpty():
            break
        here = _with_deletions(open_states.unionByName(entering.where(F.col("depth") == depth).select(*STATE)))
        below = _step(here, edges.where(F.col("depth") == depth).drop("depth"))
        paths.append(scratch_path(spark, "trie-frontier"))
        # A deletion may use up the letters at a word's end without going down.
        below.unionByName(here.where(_done())).write.parquet(paths[-1])
        frontier = spark.read.schema(schema).parquet(paths[-1])
    plain = lambda c: F.when(F.col("backward"), F.reverse(c)).otherwise(F.col(c))
    found = spark.read.schema(schema).parquet(*paths).where(_done())
    return found.select(plain("word").alias("word"), plain("node").alias("near"))


def _without_each(words: DataFrame) -> DataFrame:
    """id, size, at (place of the letter left out, from 0; -1 for none), last
    (another letter or none follows it) and kept (hash of the other letters).
    ``words``: id, word."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word_id, word in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                points = np.frombuffer(word.encode("utf-32-le"), "<u4")
                letters, n = points.tolist(), len(points)
                last = np.append(points[1:] != points[:-1], [True, True])
                kept = (_hashes_without(letters, _BASES[0]) << 31) | _hashes_without(letters, _BASES[1])
                places = np.append(np.arange(n), -1)
                for low in range(0, n + 1, _ROWS_PER_BATCH):
                    part = slice(low, low + _ROWS_PER_BATCH)
                    rows = len(places[part])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(rows, word_id), pa.int64()),
                            pa.array(np.full(rows, n), pa.int32()),
                            pa.array(places[part], pa.int32()),
                            pa.array(last[part]),
                            pa.array(kept[part], pa.int64()),
                        ],
                        names=["id", "size", "at", "last", "kept"],
                    )

    return words.select("id", "word").mapInArrow(hashed, "id long, size int, at int, last boolean, kept long")


def _hashes_without(letters: list[int], base: int) -> np.ndarray:
    """Polynomial hashes of a word without each of its letters, then of the
    whole word, from the hashes of its prefixes."""
    n = len(letters)
    head, power = np.zeros(n + 1, np.int64), np.ones(n + 1, np.int64)
    own = up = 0
    for k, letter in enumerate(letters):
        own, up = (own * base + letter) % _MODULUS, (up or 1) * base % _MODULUS
        head[k + 1], power[k + 1] = own, up
    at = np.arange(n)
    behind = power[n - at - 1]
    tail = (head[n] - head[at + 1] * behind) % _MODULUS
    return np.append((head[at] * behind + tail) % _MODULUS, head[n])


def long_neighbours(words: DataFrame) -> DataFrame:
    """word, near, each pair at least once in one direction, for words of any
    length: rows in proportion to the letters of the words. Words that share
    all letters but the one at a place are as many as the alphabet has letters,
    so no hash has more real hits."""
    numbered = materialize(words.select(F.monotonically_increasing_id().alias("id"), "word"), "long-words")
    cuts = materialize(_without_each(numbered), "long-cuts")
    a = cuts.where("at >= 0").select("kept", F.col("id").alias("a"), "at", "last", F.col("size").alias("size_a"))
    b = cuts.select("kept", F.col("id").alias("b"), F.col("at").alias("at_b"), F.col("size").alias("size_b"))
    same_place = a.join(b.withColumn("at", F.col("at_b")), ["kept", "at"]).where("size_a = size_b and a < b")
    # In a run of equal letters, leaving out the last one says it all.
    one_less = a.where("last").join(b.where("at_b = -1"), "kept").where("size_a = size_b + 1")
    hits = same_place.select("a", "b", "at", F.lit(1).alias("skip")).unionByName(one_less.select("a", "b", "at", F.lit(0).alias("skip")))
    first = numbered.select(F.col("id").alias("a"), "word")
    second = numbered.select(F.col("id").alias("b"), F.col("word").alias("near"))
    pairs = materialize(hits, "long-hits").join(first, "a").join(second, "b")
    rest = F.length("word") + 1
    same = (F.substring("word", F.lit(1), F.col("at")) == F.substring("near", F.lit(1), F.col("at"))) & (
        F.substring("word", F.col("at") + 2, rest) == F.substring("near", F.col("at") + F.col("skip") + 1, rest)
    )
    return pairs.where(same & (F.col("word") != F.col("near"))).select("word", "near")


def neighbours(words: DataFrame, trie_chars: int = TRIE_CHARS) -> DataFrame:
    """word, near: every pair of the table's words that differ by exactly one
    inserted, deleted or replaced code point, in both directions, once."""
    size = F.length("word")
    found = trie_neighbours(words.where(size <= trie_chars).select("word"), trie_chars)
    # A word of the trie may be one letter away from one that is too long for it.
    found = found.unionByName(long_neighbours(words.where(size >= trie_chars).select("word")))
    both = found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))
    return both.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the way from form to form, found by doubling.
    A form is more frequent than its word, so ways are short and end."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        now = materialize(moved, "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(words: DataFrame, factor: int = FORM_FACTOR, trie_chars: int = TRIE_CHARS) -> DataFrame:
    """word, n, n_near (its near words), form (the most frequent near word,
    ties to the smallest, where it is ``factor`` times as frequent), form_n and
    root (the end of the forms from word on). ``words``: word, n, distinct."""
    words = materialize(words.select("word", "n"), "spelling-words")
    near_n = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = neighbours(words, trie_chars).join(near_n, "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    linked = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    best_n = -F.col("best.less")
    is_form = best_n >= factor * F.col("n")
    out = words.join(linked, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, best_n).alias("form_n"),
    )
    out = materialize(out, "spelling-forms")
    roots = _roots(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
