"""Token ids of whole texts with a public tokenizer, for use inside tasks.

Byte-pair merges never cross the pieces that the tokenizer's own split makes.
That split always starts a new piece at a single white space, and at a full
stop or comma after a letter or digit. A text whose white space, stops and
commas are all of that kind is cut there, and every distinct cut is encoded
only once by the tokenizers library; the ids of all cuts are then gathered at
once. Other texts, texts with characters outside Latin-1, and texts that hold
a special token are encoded whole. A 64-bit hash finds the place of a known
cut, and its bytes are compared each time: a text in which a cut only shares
the hash of another one is encoded whole.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np

ID_BYTES = 4
_PACKED = np.dtype("<u4")
_KNOWN_CUTS = 1 << 20
_KNOWN_IDS = 1 << 23
_KNOWN_BYTES = 1 << 25
_GROUP_CHARS = 1 << 20

_LATIN = [chr(i) for i in range(256)]
_SPACE = np.array([c.isspace() and c not in "\x1c\x1d\x1e\x1f" for c in _LATIN])
_WORD = np.array([unicodedata.category(c)[0] in "LN" for c in _LATIN])
_STOP = np.array([c in ".," for c in _LATIN])
_CUT = np.array([c in " \n.," for c in _LATIN])


class _CutHash:
    """Polynomial hashes of all cuts of a buffer at once: sums of one random
    number per character times a power of an odd base, modulo 2**64, brought
    back to the cut's start by the inverse power."""

    def __init__(self) -> None:
        rng = np.random.default_rng(7)
        self._value = rng.integers(0, 2**64, 256, dtype=np.uint64)
        base = int(rng.integers(0, 2**64, dtype=np.uint64)) | 1
        self._bases = np.uint64(base), np.uint64(pow(base, -1, 2**64))
        self._powers = [np.ones(1, dtype=np.uint64)] * 2

    def __call__(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self._powers[0]) < len(buffer):
            n = 2 * len(buffer)
            self._powers = [np.concatenate([[np.uint64(1)], np.full(n - 1, b).cumprod()]) for b in self._bases]
        up, down = self._powers
        sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
        np.cumsum(self._value[buffer] * up[: len(buffer)], out=sums[1:])
        hashed = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)
        return (hashed ^ (hashed >> np.uint64(32))) * self._bases[0]


class Encoder:
    """Encodes texts to ids packed as little-endian unsigned 32-bit integers.
    The string of a special token inside a text is ordinary text, or with
    ``special_tokens`` that token, as in the library's plain call."""

    def __init__(self, path: str, special_tokens: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special_tokens
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._hash = _CutHash()
        self._forget()

    def _forget(self) -> None:
        self._known = np.empty(0, dtype=np.uint64)  # sorted; the next two go with it
        self._from = np.empty(0, dtype=np.int32)
        self._length = np.empty(0, dtype=np.int32)
        self._ids = np.empty(0, dtype=_PACKED)
        self._cut_from = np.empty(0, dtype=np.int64)  # in the bytes of all known cuts
        self._cut_size = np.empty(0, dtype=np.int64)
        self._cut_bytes = np.empty(0, dtype=np.uint8)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the count of each text."""
        found = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int32, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=_PACKED, count=int(lengths.sum())), lengths

    def _learn(self, hashes: np.ndarray, cuts: list[bytes]) -> None:
        """Add Latin-1 cuts of distinct new hashes; ``hashes`` are sorted."""
        ids, lengths = self._whole([c.decode("latin-1") for c in cuts])
        at = np.searchsorted(self._known, hashes)
        begins = (len(self._ids) + np.cumsum(lengths) - lengths).astype(np.int32)
        self._known = np.insert(self._known, at, hashes)
        self._from = np.insert(self._from, at, begins)
        self._length = np.insert(self._length, at, lengths)
        self._ids = np.concatenate([self._ids, ids])
        sizes = np.fromiter(map(len, cuts), dtype=np.int64, count=len(cuts))
        self._cut_from = np.insert(self._cut_from, at, len(self._cut_bytes) + np.cumsum(sizes) - sizes)
        self._cut_size = np.insert(self._cut_size, at, sizes)
        self._cut_bytes = np.concatenate([self._cut_bytes, np.frombuffer(b"".join(cuts), dtype=np.uint8)])

    def _same(self, buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Whether each cut of the buffer has the bytes of the known cut at its slot."""
        same = sizes == self._cut_size[slot]
        first, size, known = starts[same], sizes[same], self._cut_from[slot[same]]
        if len(first):
            begins = np.cumsum(size) - size
            at = np.arange(int(size.sum()))
            equal = buffer[at + np.repeat(first - begins, size)] == self._cut_bytes[at + np.repeat(known - begins, size)]
            same[same] = np.logical_and.reduceat(equal, begins)
        return same

    def _cut(self, texts: list[bytes]) -> list[bytes | None]:
        """The packed ids of Latin-1 texts, none of them empty; None for those
        that cannot be cut surely."""
        buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        first = bounds[:-1]
        space = _SPACE[buffer]
        after_space, after_word = np.empty_like(space), np.empty_like(space)
        after_space[1:], after_word[1:] = space[:-1], _WORD[buffer][:-1]
        after_space[first], after_word[first] = False, True
        unsure = np.flatnonzero((space & after_space) | (_STOP[buffer] & ~after_word))
        sure = np.ones(len(texts), dtype=bool)
        sure[np.searchsorted(first, unsure, side="right") - 1] = False
        here = _CUT[buffer]
        here[first] = True
        starts = np.flatnonzero(here)
        ends = np.append(starts[1:], len(buffer))
        if not sure.all():
            own = sure[np.searchsorted(first, starts, side="right") - 1]
            starts, ends = starts[own], ends[own]
        hashes, example, which = np.unique(self._hash(buffer, starts, ends), return_index=True, return_inverse=True)
        if len(self._known) > _KNOWN_CUTS or len(self._ids) > _KNOWN_IDS or len(self._cut_bytes) > _KNOWN_BYTES:
            self._forget()
        new = ~np.isin(hashes, self._known, assume_unique=True)
        if new.any():
            raw, spans = buffer.tobytes(), example[new]
            cuts = [raw[a:b] for a, b in zip(starts[spans].tolist(), ends[spans].tolist(), strict=True)]
            self._learn(hashes[new], cuts)
        slot = np.searchsorted(self._known, hashes)[which]
        other = starts[~self._same(buffer, starts, ends - starts, slot)]
        sure[np.searchsorted(first, other, side="right") - 1] = False
        lengths = self._length[slot].astype(np.int64)
        done = np.concatenate([[0], np.cumsum(lengths)])
        gather = np.arange(done[-1]) + np.repeat(self._from[slot] - done[:-1], lengths)
        ids = self._ids[gather].tobytes()
        # Token bounds of each text: the cuts that start before its first character are earlier texts'.
        token_bounds = (done[np.searchsorted(starts, bounds)] * ID_BYTES).tolist()
        return [
            ids[a:b] if ok else None for a, b, ok in zip(token_bounds, token_bounds[1:], sure.tolist(), strict=False)
        ]

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        latin = [None if any(a in t for a in self._added) else _latin(t) for t in texts]
        cut = [t for t in latin if t]
        found = iter(self._cut(cut) if cut else [])
        for text, raw in zip(texts, latin, strict=True):
            ids = next(found) if raw else None
            if not text:
                yield b""
            else:
                yield self._whole([text])[0].tobytes() if ids is None else ids

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The packed ids of each text, in order; none for a null text."""
        texts = iter(texts)
        while group := _take(texts, _GROUP_CHARS):
            yield from self._group(group)


def _latin(text: str) -> bytes | None:
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def _take(texts: Iterator[str | None], chars: int) -> list[str]:
    """The next texts, up to about ``chars`` characters."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1]) + 1
        if size >= chars:
            break
    return group


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary file, with the ids of the library's plain call."""
    return Encoder(path, special_tokens=True)
