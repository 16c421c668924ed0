"""Columns of numbers inside tasks: sorted, counted, and packed to travel."""

from __future__ import annotations

import numpy as np
import zstandard

#: Entries that a task sums before it sends them on.
SUMMED = 4_000_000


def starts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = starts(keys)
    return keys[at], *(np.add.reduceat(value[order], at) if len(at) else value[:0] for value in values)


def tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each occurs."""
    ordered = np.sort(keys)
    at = starts(ordered)
    return ordered[at], np.diff(at, append=len(ordered)).astype(np.uint64)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(column).view(np.uint8).reshape(len(column), -1).T.tobytes() for column in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    raw, sizes = zstandard.ZstdDecompressor().decompress(data), [np.dtype(kind).itemsize for kind in kinds]
    count, at, found = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes):
        planes = np.frombuffer(raw, np.uint8, count * size, at).reshape(size, count)
        found.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += count * size
    return found


class Tally:
    """Counts of keys: sums what it was given, and says when it holds so many distinct keys that they should be taken."""

    def __init__(self) -> None:
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.raw: list[np.ndarray] = []
        self.waiting = 0

    def add(self, keys: np.ndarray) -> bool:
        self.raw.append(keys)
        self.waiting += len(keys)
        if self.waiting >= SUMMED // 2:
            self._sum()
        return len(self.keys) > SUMMED

    def _sum(self) -> None:
        if self.raw:
            keys, counts = tally(np.concatenate(self.raw))
            self.keys, self.counts = summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
            self.raw, self.waiting = [], 0

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self._sum()
        taken, self.keys, self.counts = (self.keys, self.counts), np.empty(0, np.uint64), np.empty(0, np.uint64)
        return taken
