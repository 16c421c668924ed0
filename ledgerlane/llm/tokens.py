"""Words of texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

from ledgerlane.llm.common import mixed


@dataclass(frozen=True)
class Words:
    """Word hashes of several texts in a row. ``ends``: where each text ends; ``owner``: the text of each word."""

    hashes: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends)), self.counts)

    def windows(self, span: int) -> np.ndarray:
        """The places where a window of ``span`` words starts and stays in its text."""
        left = np.repeat(self.ends, self.counts) - np.arange(len(self.hashes))
        return np.flatnonzero(left >= span)

    def seeds(self, offsets: tuple[int, ...], places: np.ndarray) -> np.ndarray:
        """One hash per place of the words at ``offsets`` from it, in order."""
        found = np.zeros(len(places), np.uint64)
        for k, offset in enumerate(offsets):
            found += self.hashes[places + offset] * _FACTORS[k % len(_FACTORS)] ^ np.uint64(k)
            found = (found << np.uint64(7)) | (found >> np.uint64(57))
        return mixed(found)


#: Odd multipliers, one per position in a window, from a fixed rule.
_FACTORS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def hashed(rows: list[list[bytes]]) -> Words:
    """The words of several texts, hashed."""
    ends = np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))
    hash_of = xxhash.xxh3_64_intdigest
    return Words(np.array([hash_of(word) for row in rows for word in row], np.uint64), ends)
