from __future__ import annotations

import zlib

import numpy as np
import pytest

from ledgerlane.llm import sharding

SCHEMA = "doc_id long, text string, size string, shard string, _slot string"


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 15, 16, 17, 63, 1000, 4097])
@pytest.mark.parametrize("seed", [0, 1, 123456789])
def test_permutation_and_its_inverse(n, seed):
    rows = np.arange(n)
    places = sharding.Permutation(n, seed).place(rows)
    assert sorted(places.tolist()) == rows.tolist()
    assert (sharding.Permutation(n, seed).row(places) == rows).all()


def plain_place(row, n, seed):
    """The network in plain integers."""
    full = (1 << 64) - 1

    def mix(v):
        v &= full
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 & full
        v = (v ^ v >> 27) * 0x94D049BB133111EB & full
        return v ^ v >> 31

    half = 1
    while 1 << (2 * half) < n:
        half += 1
    mask = (1 << half) - 1
    while True:
        left, right = row >> half, row & mask
        for k in range(4):
            left, right = right, left ^ (mix(right ^ mix(k + seed * 4 + 1)) & mask)
        row = left << half | right
        if row < n:
            return row


def test_equals_plain_integers():
    for n, seed in ((10, 0), (777, 5), (70_000, 9)):
        rows = np.arange(0, n, max(1, n // 300))
        assert sharding.Permutation(n, seed).place(rows).tolist() == [plain_place(int(r), n, seed) for r in rows]


def test_seeds_and_neighbours_are_spread():
    places = sharding.Permutation(10_000, 1).place(np.arange(10_000))
    assert abs(np.corrcoef(places, np.arange(10_000))[0, 1]) < 0.05
    assert (places != sharding.Permutation(10_000, 2).place(np.arange(10_000))).mean() > 0.99


def test_rows_have_shards_and_slots_that_can_be_computed(spark):
    rows = [(k * 3 % 1009 - 50, f"text {k % 10} é" if k % 13 else None, "s", "h", "t") for k in range(1009)]
    found = sharding.shard_rows(spark.createDataFrame(rows, SCHEMA).repartition(6), 8, seed=4).collect()
    order = sorted(found, key=lambda r: r.row_number)
    assert [r.row_number for r in order] == list(range(1009)) and [r.doc_id for r in order] == sorted(r[0] for r in rows)
    shard, slot = sharding.locate(np.arange(1009), 1009, 8, 4)
    assert [(r.shard, r.slot) for r in order] == list(zip(shard.tolist(), slot.tolist()))
    assert sharding.row_at(shard, slot, 1009, 8, 4).tolist() == list(range(1009))
    counts = np.bincount(shard)
    assert counts.max() - counts.min() <= 1
    for s in range(8):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in found)


def test_reruns_and_other_partitions_agree(spark):
    frame = spark.range(500).selectExpr("id AS doc_id", "concat('t', id % 7) AS text")
    runs = [sorted(map(tuple, sharding.shard_rows(frame.repartition(n), 8, 0).collect())) for n in (1, 7)]
    assert runs[0] == runs[1]


def test_odd_rows(spark):
    rows = [(None, "a", *"xyz"), (None, None, *"xyz"), (1, "", *"xyz"), (1, "", *"xyz"), (2, "long " * 100_000, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = sharding.shard_rows(frame, 8, 0).orderBy("row_number").collect()
    assert [(r.doc_id, r.size) for r in found] == [(None, 1), (None, 2), (1, 1), (1, 1), (2, 500_001)]
    assert len({(r.shard, r.slot) for r in found}) == 5
    assert sharding.shard_rows(frame.limit(0), 8, 0).collect() == []
