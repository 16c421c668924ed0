"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 .. n-1 in ascending document id; a keyed permutation of these numbers gives every row its place in the
shuffled corpus, and place ``p`` is slot ``p div shards`` of shard ``p mod shards``. Shard and slot of a row number, and the
row number of a shard and slot, follow from (n, shards, seed) alone, without a look at the data. Counts of shards differ by
one at most.

NULL text has size 1 and the CRC-32 of an empty text. Rows without an id are numbered first, repeated ids in the order of
their texts' CRC-32 and size; equal rows get places of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import mixed
from ledgerlane.operators.numbering import number_rows

ROUNDS = 4


class Permutation:
    """A keyed permutation of 0 .. n-1: a balanced Feistel network over the next power of four, walked until it lands below n."""

    def __init__(self, n: int, seed: int) -> None:
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = mixed(np.arange(ROUNDS, dtype=np.uint64) + np.uint64(seed % (1 << 63)) * np.uint64(ROUNDS) + np.uint64(1))

    def _step(self, values: np.ndarray, backwards: bool) -> np.ndarray:
        half = np.uint64(self.half)
        left, right = values >> half, values & self.mask
        if backwards:
            for key in self.keys[::-1]:
                left, right = right ^ (mixed(left ^ key) & self.mask), left
        else:
            for key in self.keys:
                left, right = right, left ^ (mixed(right ^ key) & self.mask)
        return (left << half) | right

    def _walk(self, values: np.ndarray, backwards: bool) -> np.ndarray:
        out = self._step(np.asarray(values).astype(np.uint64), backwards)
        while (outside := np.flatnonzero(out >= self.n)).size:
            out[outside] = self._step(out[outside], backwards)
        return out.astype(np.int64)

    def place(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, backwards=False)

    def row(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, backwards=True)


def locate(rows: np.ndarray, n: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    places = Permutation(n, seed).place(rows)
    return places % shards, places // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int) -> np.ndarray:
    """Row numbers at the given shards and slots."""
    return Permutation(n, seed).row(np.asarray(slot) * shards + np.asarray(shard))


def shard_rows(docs: DataFrame, shards: int, seed: int) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard and slot of every row.

    Only ids, sizes and checksums are sorted and numbered; texts stay where they are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    numbered = number_rows(rows, order, "row_number")
    n = numbered.count()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("row_number").to_numpy() - 1
            shard, slot = locate(number, n, shards, seed)
            columns = [*batch.columns[:3], pa.array(number), pa.array(shard.astype(np.int32)), pa.array(slot)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "text_crc32", "row_number", "shard", "slot"])

    numbered = numbered.select("doc_id", "size", "text_crc32", "row_number")
    return numbered.mapInArrow(place, "doc_id long, size long, text_crc32 long, row_number long, shard int, slot long")
