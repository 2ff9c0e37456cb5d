"""Token-id files of independent zstandard frames with a trailing seek table.

A file holds, in ascending doc_id order, one zstandard frame per document (its
ids as little-endian unsigned 32-bit integers); a skippable frame with the
doc_ids; and the seek table of the public seekable format, a skippable frame
with each frame's compressed size, content size and xxh64 checksum (low 32
bits). A newline ends the file. Readers find a document in the two tables and
decompress its frame only.

Files are written by Spark's text sink, one row per file, so they reach any
file system that Spark writes to and appear only when a task commits. The
folders carry the file number and its token count, so the token offsets of the
files come from the listing alone.

Edge cases: a null or empty text gives a frame that holds the end id only; a
null doc_id comes first; rows that share a doc_id stay in a fixed order (by
text hash); an empty table gives no file and reads as no rows. A corrupt frame
raises on reading.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.llm.common import documents
from tabflow.llm.tokens import encoder

FILE_BYTES = 4 << 20
_FILES = 1 << 32  # room for the file numbers of one task

# Fixed values of the zstandard seekable format; the doc_id table is our own skippable frame.
SKIPPABLE_IDS = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

_ENTRY = struct.Struct("<III")
_HEAD = struct.Struct("<II")
_FOOTER = struct.Struct("<IBI")
_ID = struct.Struct("<?q")


class FileBuilder:
    """Collects the frames of one file."""

    def __init__(self) -> None:
        import zstandard

        self._compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.clear()

    def clear(self) -> None:
        self._frames: list[bytes] = []
        self._ids: list[bytes] = []
        self._entries: list[bytes] = []
        self.size = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        frame = self._compressor.compress(ids)
        self._frames.append(frame)
        self._ids.append(_ID.pack(doc_id is not None, doc_id or 0))
        self._entries.append(_ENTRY.pack(len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.size += len(frame)
        self.tokens += len(ids) // 4

    def content(self) -> bytes:
        ids, table = b"".join(self._ids), b"".join(self._entries)
        footer = _FOOTER.pack(len(self._frames), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        return b"".join(
            [
                *self._frames,
                _HEAD.pack(SKIPPABLE_IDS, len(ids)),
                ids,
                _HEAD.pack(SKIPPABLE_SEEK_TABLE, len(table) + len(footer)),
                table,
                footer,
            ]
        )


def seek_table(content: bytes) -> list[tuple[int | None, int, int, int, int]]:
    """(doc_id, frame start, compressed size, content size, checksum) of every
    frame, from the two tables at the end of the file."""
    end = len(content) - 1  # the newline
    n, flags, magic = _FOOTER.unpack_from(content, end - _FOOTER.size)
    if magic != SEEKABLE_MAGIC or flags != WITH_CHECKSUMS or content[end:] != b"\n":
        raise ValueError("not a seekable token file")
    table = end - _FOOTER.size - n * _ENTRY.size
    ids = table - _HEAD.size - n * _ID.size
    if _HEAD.unpack_from(content, ids - _HEAD.size) != (SKIPPABLE_IDS, n * _ID.size):
        raise ValueError("damaged seek table")
    out, start = [], 0
    for (known, doc_id), (packed, size, check) in zip(
        _ID.iter_unpack(content[ids : ids + n * _ID.size]),
        _ENTRY.iter_unpack(content[table : table + n * _ENTRY.size]),
        strict=True,
    ):
        out.append((doc_id if known else None, start, packed, size, check))
        start += packed
    return out


def frame_ids(content: bytes, start: int, packed: int, size: int, check: int) -> bytes:
    """Decompress one frame and verify its checksum."""
    import xxhash
    import zstandard

    ids = zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=size)
    if len(ids) != size or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != check:
        raise ValueError("damaged frame")
    return ids


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode all documents and write the files in ascending doc_id order. Only
    the ids are looked at to choose the ranges; texts move once."""

    def files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, builder, end = encoder(tokenizer), FileBuilder(), end_id.to_bytes(4, "little")
        number = TaskContext.get().partitionId() * _FILES

        def finished() -> pa.RecordBatch:
            nonlocal number
            out = [pa.array([number], pa.int64()), pa.array([builder.tokens], pa.int64()), pa.array([builder.content()], pa.binary())]
            number += 1
            builder.clear()
            return pa.RecordBatch.from_arrays(out, names=["file", "tokens", "content"])

        for batch in batches:
            for doc_id, ids in zip(batch[0].to_pylist(), tokens.encode(t.as_py() for t in batch[1]), strict=True):
                builder.add(doc_id, ids + end)
                if builder.size >= FILE_BYTES:
                    yield finished()
        if builder.tokens:
            yield finished()

    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        documents(docs, id_col, text_col)
        .repartitionByRange(ranges, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .mapInArrow(files, "file long, tokens long, content binary")
        .withColumn("content", F.col("content").cast("string"))  # the same bytes; the sink adds the newline
        .write.partitionBy("file", "tokens")
        .text(path)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    if "file" not in files.columns:  # a folder without files has no partition columns
        files = files.withColumns({"file": F.lit(0), "tokens": F.lit(0)})
    return files


def file_offsets(spark: SparkSession, path: str) -> DataFrame:
    """file and the ids of all files before it, from the listing alone."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    listed = _files(spark, path).select(F.col("file").cast("long"), F.col("tokens").cast("long"))
    return listed.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("file_start"))


def read_tokens(spark: SparkSession, path: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """doc_id, file, start_in_file (ids before the document in its file),
    n_tokens, ids_crc32 and ids; only of the ``wanted`` doc_ids if given, whose
    frames alone are decompressed."""
    chosen = None if wanted is None else frozenset(wanted)
    names = ["doc_id", "file", "start_in_file", "n_tokens", "ids_crc32", "ids"]
    types = [pa.int64()] * 5 + [pa.binary()]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch[0].to_pylist(), batch[1], strict=True):
                content, before, rows = content.as_py(), 0, []
                for doc_id, start, packed, size, check in seek_table(content):
                    if chosen is None or doc_id in chosen:
                        ids = frame_ids(content, start, packed, size, check)
                        rows.append((doc_id, file, before, size // 4, zlib.crc32(ids), ids))
                    before += size // 4
                columns = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return (
        _files(spark, path)
        .select(F.col("file").cast("long"), "content")
        .mapInArrow(read, "doc_id long, file long, start_in_file long, n_tokens long, ids_crc32 long, ids binary")
    )
