"""Sum-of-squares packing of tokenized documents into fixed-size sequences.

Documents become pieces of at most ``capacity`` tokens; only longer ones are
cut, and all their pieces but the first are full. Pieces are dealt at random
(by hash) to groups of about ``GROUP_PIECES``, full pieces apart from the others
as each is a sequence of its own, and each group is packed by one streaming
task, longest piece first: a piece goes where the sum of the squared
counts of open sequences per residual gap becomes smallest, among the open
sequences it fits in; a new one is opened only if it fits in none, as the aim
is few sequences. A group leaves a few sequences part-filled, so groups cost
at most a few sequences in every GROUP_PIECES pieces.

Edge cases: a null text is an empty one, whose only token is the end id; a
document longer than the capacity fills whole sequences; repeated rows are
packed one by one; a null doc_id is kept as it is, and such rows are dealt by
their place in the input, so equal ones spread (a table that holds them has to
be read from files, as its place must not change when a task runs again); an
empty table gives an empty result. The order within a group is total up to equal rows, so a task
that runs again repeats its result.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import documents, unsigned_hash
from tabflow.llm.tokens import encoder

GROUP_PIECES = 1 << 16
FULL_GROUPS = 1 << 12  # over which full pieces are dealt
_SEQUENCES = 1 << 40  # room for the sequence numbers of one group
_BYTES = 4  # of a packed id

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class SumOfSquares:
    """Places sizes one by one; ``place`` gives (sequence, offset)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequences = 0
        self._open = np.zeros(capacity + 1, dtype=np.int64)  # open sequences per gap; gap 0 is never open
        self._by_gap: dict[int, list[int]] = defaultdict(list)

    def place(self, size: int) -> tuple[int, int]:
        counts, capacity = self._open, self.capacity
        gap, best = capacity, np.inf
        # Half the change of the sum, less a constant: a gap g becomes g - size, and gap 0 does not count.
        if size < capacity and counts[size]:
            gap, best = size, -counts[size]
        larger = counts[size + 1 : capacity]
        if larger.size:
            change = np.where(larger > 0, counts[1 : capacity - size] - larger + 0.5, np.inf)
            k = int(change.argmin())
            if change[k] < best:
                gap = size + 1 + k
        if gap == capacity:
            sequence = self.sequences
            self.sequences += 1
        else:
            sequence = self._by_gap[gap].pop()
            counts[gap] -= 1
        if left := gap - size:
            self._by_gap[left].append(sequence)
            counts[left] += 1
        return sequence, capacity - gap


def cut(n_tokens: int, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length) of a document; the first piece takes the rest."""
    first = n_tokens % capacity or capacity
    yield 0, 0, min(first, n_tokens)
    for piece, start in enumerate(range(first, n_tokens, capacity), 1):
        yield piece, start, capacity


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ``ids``,
    packed as little-endian unsigned 32-bit integers)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    end = end_id.to_bytes(_BYTES, "little")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch[0].to_pylist(), tokens.encode(t.as_py() for t in batch[1]), strict=True):
                ids += end
                for piece, start, length in cut(len(ids) // _BYTES, capacity):
                    own = ids[start * _BYTES : (start + length) * _BYTES]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own), own))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns[: len(names)], types, strict=False)], names=names
            )

    return documents(docs, id_col, text_col).mapInArrow(encode, PIECE + (", ids binary" if with_ids else ""))


def pack(parts: DataFrame, capacity: int, expected_pieces: int) -> DataFrame:
    """``parts`` (PIECE columns) with sequence_id and offset.
    ``expected_pieces``, the count of pieces below the capacity or a bound on
    it, sets the number of groups."""
    groups = max(1, math.ceil(expected_pieces / GROUP_PIECES))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packer = None, SumOfSquares(capacity)
        for batch in batches:
            sequences, offsets = [], []
            for g, length in zip(batch["group"].to_pylist(), batch["length"].to_pylist(), strict=True):
                if g != group:
                    group, packer = g, SumOfSquares(capacity)
                sequence, offset = packer.place(length)
                sequences.append(g * _SEQUENCES + sequence)
                offsets.append(offset)
            own = [batch[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    # Rows without an id may be equal in all columns, so their place in the input spreads them.
    place_of_unnamed = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    mixed = unsigned_hash("doc_id", "start", "length", "ids_crc32", place_of_unnamed)
    # A full piece is a sequence of its own, so it needs no group; all of one document go to any task.
    full = F.col("length") >= capacity
    deal = F.when(full, groups + F.pmod(mixed, F.lit(FULL_GROUPS))).otherwise(F.pmod(mixed, F.lit(groups)))
    tasks = max(groups, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        parts.select("doc_id", "piece", "start", "length", "ids_crc32", deal.alias("group"))
        .repartition(tasks, "group")
        .sortWithinPartitions("group", F.desc("length"), "doc_id", "piece", "ids_crc32")
        .mapInArrow(place, PIECE + ", sequence_id long, offset long")
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """Cut and pack all documents. A document has one piece below the capacity
    at most, so the row count sets the number of groups."""
    return pack(pieces(docs, tokenizer, end_id, capacity), capacity, docs.count())


def sequences(packed: DataFrame, parts_with_ids: DataFrame) -> DataFrame:
    """The token sequences themselves: sequence_id and ids in offset order.
    Needs unique (doc_id, piece). A sequence has at most ``capacity`` pieces."""
    joined = packed.select("sequence_id", "offset", "doc_id", "piece").join(
        parts_with_ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"]
    )
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(placed, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return joined.groupBy("sequence_id").agg(whole.alias("ids"))
