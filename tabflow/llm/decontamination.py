"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may differ from a passage by k = m * error_rate edits.
It is split into k + 1 pieces; a passage within k edits holds at least one
piece unchanged. One scan of every whole text finds all pieces of all items
(Aho-Corasick), each hit gives a window that a count of the item's short
disjoint grams may rule out, and Myers' bit-parallel distance decides.

Texts and items are compared lower-cased with every run of white space as one
space; spans are positions of the text as it is. The scan shuffles nothing.
Items come in blocks of bounded size, one scan a block.

Edge cases: null and empty texts hold nothing; null and blank items match
nothing; items shorter than 1 / error_rate must match exactly and not begin or
end inside a word (of a script that parts words), so "the" is not found in
"theatre"; repeated rows
and items are matched one by one; null ids are kept as they are; an empty
table on either side gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import documents, materialize

ERROR_RATE = 0.1
BLOCK_CHARS = 1 << 20
GRAM = 4
# Scripts that set words without spaces (Chinese, Japanese, Korean) begin here.
UNPARTED = "\u2e80"
_RUN = re.compile(" {2,}")
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]

MATCHES = "doc_id long, item_id long, start long, end long, distance long"


def _spaced(text: str) -> str:
    """Lower case with plain spaces, of the same length."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for space in _SPACES:
        lower = lower.replace(space, " ")
    return lower


def normalized(text: str) -> str:
    """Lower case with one space for each run of white space."""
    spaced = _spaced(text)
    return _RUN.sub(" ", spaced) if "  " in spaced else spaced


class Places:
    """Positions of a text for those of its normalized form."""

    def __init__(self, text: str):
        self._after, self._lost, lost = [], [], 0
        for run in _RUN.finditer(_spaced(text)):
            self._after.append(run.start() - lost + 1)
            lost += run.end() - run.start() - 1
            self._lost.append(lost)

    def of(self, position: int) -> int:
        passed = bisect_right(self._after, position)
        return position + (self._lost[passed - 1] if passed else 0)


class Pattern:
    """An item's bit masks, and Myers' distance of it against texts."""

    def __init__(self, item: str, errors: int):
        self.item, self.size, self.errors = item, len(item), errors
        self._forward, self._back = self._masks(item), self._masks(item[::-1])
        self._grams = [item[i : i + GRAM] for i in range(0, self.size - GRAM + 1, GRAM)]

    @staticmethod
    def _masks(item: str) -> dict[str, int]:
        masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            masks[c] |= 1 << i
        return dict(masks)

    def pieces(self) -> Iterator[tuple[int, str]]:
        """(offset, piece), error budget plus one of them, of even lengths."""
        n = self.errors + 1
        for i in range(n):
            a, b = self.size * i // n, self.size * (i + 1) // n
            yield a, self.item[a:b]

    def possible(self, window: str) -> bool:
        """Each edit spoils one of the item's disjoint grams at most."""
        missing = 0
        for gram in self._grams:
            if gram not in window:
                missing += 1
                if missing > self.errors:
                    return False
        return True

    def _scores(self, masks: dict[str, int], text: Iterable[str], anchored: bool) -> Iterator[int]:
        """After each character the distance of the item to the nearest string
        that ends there (``anchored``: to all of the text so far)."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        for c in text:
            equal = masks.get(c, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (full & ~(horizontal | plus))
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = (up << 1 | anchored) & full
            down = down << 1 & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
            yield score

    def matches(self, window: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, distance) of the passages within the error budget; of
        overlapping ends the nearest."""
        best: tuple[int, int] | None = None
        for end, score in enumerate(self._scores(self._forward, window, False), 1):
            if best is not None and end - best[1] > self.size // 2:
                yield self._span(window, *best)
                best = None
            if score <= self.errors and (best is None or score < best[0]):
                best = (score, end)
        if best is not None:
            yield self._span(window, *best)

    def _span(self, window: str, score: int, end: int) -> tuple[int, int, int]:
        low = max(0, end - self.size - self.errors)
        back = window[low:end][::-1]
        for length, s in enumerate(self._scores(self._back, back, True), 1):
            if s == score:
                return end - length, end, score
        return end, end, score  # an item within its own budget of nothing


class Matcher:
    """All items of one block against texts."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        import ahocorasick

        self._ids, self._patterns = [], []
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            item = normalized(text).strip()
            if not item:
                continue
            pattern = Pattern(item, int(len(item) * error_rate))
            for offset, piece in pattern.pieces():
                owners[piece].append((len(self._patterns), offset))
            self._ids.append(item_id)
            self._patterns.append(pattern)
        self._automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self._automaton.add_word(piece, (len(piece), where))
        self._automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int | None, int, int, int]]:
        """(item_id, start, end, distance) of every match in a text."""
        if not self._patterns:
            return
        whole, text = text, normalized(text)
        places: Places | None = None
        starts: dict[int, set[int]] = defaultdict(set)
        for last, (size, where) in self._automaton.iter(text):
            for k, offset in where:
                starts[k].add(last + 1 - size - offset)
        for k, found in starts.items():
            pattern = self._patterns[k]
            if not pattern.errors:
                found = {start for start in found if _bordered(text, start, start + pattern.size)}
            for low, high in _windows(sorted(found), pattern.size, pattern.errors, len(text)):
                window = text[low:high]
                if pattern.possible(window):
                    for start, end, distance in pattern.matches(window):
                        places = places or Places(whole)
                        yield self._ids[k], places.of(low + start), places.of(low + end - 1) + 1, distance


def _bordered(text: str, start: int, end: int) -> bool:
    """No word goes on over an end of ``text[start:end]``."""
    return not (_joined(text[start - 1 : start], text[start : start + 1]) or _joined(text[end - 1 : end], text[end : end + 1]))


def _joined(before: str, after: str) -> bool:
    return before.isalnum() and after.isalnum() and max(before, after) < UNPARTED


def _windows(starts: list[int], size: int, errors: int, limit: int) -> Iterator[tuple[int, int]]:
    """Where an item may lie whose start, without edits, is one of ``starts``;
    overlapping windows become one."""
    low = high = None
    for start in starts:
        a, b = max(0, start - errors), min(limit, start + size + errors)
        if b - a < size - errors:
            continue
        if high is not None and a <= high:
            high = max(high, b)
            continue
        if high is not None:
            yield low, high
        low, high = a, b
    if high is not None:
        yield low, high


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about BLOCK_CHARS, one block at a time here."""
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        block.append((item_id, text))
        size += len(text)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _items(benchmark: DataFrame, item_col: str = "item_id") -> DataFrame:
    text = F.col("text").cast("string").alias("text")
    return benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), text).where("text is not null")


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, item_col: str = "item_id"
) -> DataFrame:
    """MATCHES: each passage of a document that is within the error budget of
    a benchmark item (``benchmark``: ``item_col`` and text)."""
    named = documents(docs)
    parts = [_scan(named, block, error_rate) for block in _blocks(_items(benchmark, item_col))]
    return reduce(DataFrame.unionByName, parts) if parts else named.limit(0).mapInArrow(lambda _: iter(()), MATCHES)


def _scan(named: DataFrame, block: list[tuple[int | None, str]], error_rate: float) -> DataFrame:
    names = ["doc_id", "item_id", "start", "end", "distance"]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, error_rate)
        for batch in batches:
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True)
                for match in matcher.find(text.as_py() or "")
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return named.mapInArrow(scan, MATCHES)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs`` without those whose text holds a benchmark item. A
    row is found again by its doc_id and the SHA-256 of its text, as the text
    alone decides: a null or repeated doc_id spares or condemns no other row."""
    parts = [_holders(documents(docs), block, error_rate) for block in _blocks(_items(benchmark))]
    if not parts:
        return docs
    # Written first, so its measured size decides between a broadcast and a shuffle of the texts.
    found = materialize(reduce(DataFrame.unionByName, parts).distinct(), "contaminated").alias("_found")
    same = F.col("_docs.doc_id").cast("long").eqNullSafe(F.col("_found.doc_id")) & (
        F.sha2(F.col("_docs.text").cast("string"), 256) == F.col("_found.digest")
    )
    return docs.alias("_docs").join(found, same, "left_anti")


def _holders(named: DataFrame, block: list[tuple[int | None, str]], error_rate: float) -> DataFrame:
    """doc_id and digest of the texts that hold an item of the block; a text's
    scan ends with its first one."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, error_rate)
        for batch in batches:
            held = [
                (doc_id, sha256(text.as_buffer()).hexdigest())
                for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True)
                if next(matcher.find(text.as_py() or ""), None)
            ]
            ids, digests = zip(*held, strict=True) if held else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "digest"])

    return named.mapInArrow(scan, "doc_id long, digest string")
