"""A cuckoo filter over 128-bit keys given as two 64-bit halves.

Four 16-bit fingerprints per bucket; a key's second bucket is the first one
xor a hash of its fingerprint, so a fingerprint can move without its key.
Supports insertion, deletion and vectorized lookup; no false negatives.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
LOAD = 0.85
_KICKS = 500
_MIX = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio as a 64-bit fraction
_HEADER = 8


class FilterFull(RuntimeError):
    """No free slot was found; rebuild with more room."""


class CuckooFilter:
    def __init__(self, table: np.ndarray, stored: int = 0):
        self.table, self.stored = table, stored
        self._mask = np.uint64(len(table) - 1)

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < max(n, 1):
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    def room(self) -> int:
        """Keys it can hold within the load it is built for."""
        return int(self.table.size * LOAD)

    def _places(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        print_ = (low.astype(np.int64).view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1  # 0 marks a free slot
        first = high.astype(np.int64).view(np.uint64) & self._mask
        return print_, first, first ^ self._step(print_)

    def _step(self, print_: np.ndarray) -> np.ndarray:
        return ((print_.astype(np.uint64) * _MIX) >> np.uint64(32)) & self._mask

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        print_, first, second = self._places(high, low)
        wanted = print_[:, None]
        return (self.table[first] == wanted).any(axis=1) | (self.table[second] == wanted).any(axis=1)

    def _put(self, bucket: int, print_: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if free.size:
            self.table[bucket, free[0]] = print_
        return bool(free.size)

    def insert(self, high: np.ndarray, low: np.ndarray) -> None:
        """Add distinct keys that are not in yet."""
        for print_, first, second in zip(*(a.tolist() for a in self._places(high, low)), strict=True):
            if not (self._put(first, print_) or self._put(second, print_)):
                self._move(second, print_)
            self.stored += 1

    def _move(self, bucket: int, print_: int) -> None:
        for kick in range(_KICKS):
            slot = kick % SLOTS
            print_, self.table[bucket, slot] = int(self.table[bucket, slot]), print_
            bucket ^= int(self._step(np.array([print_], dtype=np.uint16))[0])
            if self._put(bucket, print_):
                return
        raise FilterFull

    def delete(self, high: np.ndarray, low: np.ndarray) -> None:
        """Remove keys that were inserted."""
        for print_, first, second in zip(*(a.tolist() for a in self._places(high, low)), strict=True):
            for bucket in (first, second):
                held = np.flatnonzero(self.table[bucket] == print_)
                if held.size:
                    self.table[bucket, held[0]] = 0
                    self.stored -= 1
                    break
            else:
                raise KeyError("key was never inserted")

    def to_bytes(self) -> bytes:
        return self.stored.to_bytes(_HEADER, "little") + self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, dtype="<u2", offset=_HEADER).reshape(-1, SLOTS).astype(np.uint16)
        return cls(table, int.from_bytes(data[:_HEADER], "little"))


def build(high: np.ndarray, low: np.ndarray) -> CuckooFilter:
    """A filter of the given distinct keys, doubled until all fit."""
    n = len(high)
    while True:
        made = CuckooFilter.for_keys(n)
        try:
            made.insert(high, low)
            return made
        except FilterFull:
            n = made.table.size
