"""SimHash near-duplicates: 64-bit fingerprints, BK-trees over shards of them, connected components of the links.

A fingerprint bit is set if it is set in more than half of the hashes of the document's shingles, repeats included. Equal
fingerprints are one before any search. Two fingerprints at most ``radius`` bits apart agree in one of ``radius + 1`` blocks of
bits, so each goes to one shard per block, named by the block's value; a shard with more than ``SHARD`` fingerprints is split
again by blocks of its remaining bits, until it is small. Each shard gets a BK-tree (children keyed by their Hamming distance to
the parent) in the task that holds it, and every fingerprint of the shard follows only the edges that can lead within the radius.
What is found leaves the tree, so a shard of n fingerprints gives at most n - 1 links, however many pairs lie within the radius.
A shard's tree meets its searches through the shuffle: trees of a whole corpus have no bound that would let them be broadcast.

NULL and empty texts have fingerprint zero and are linked like any other. Rows without an id take part; a component's id is
the smallest id in it, NULL if none has one. Repeated rows share a component. An empty table gives no rows. Other columns are
ignored by ``near_duplicates`` and pass through ``keep_one`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import drop_rows, fresh, texts_of
from ledgerlane.llm.components import connected_components
from ledgerlane.sources.publish import store

BITS = 64
SEED = 42
#: Fingerprints in one tree.
SHARD = 4096
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of a UTF-8 text; ASCII letters count in lower case."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, total = b" ".join(words), len(words) - shingle + 1
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[:total].tolist(), ends[shingle - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for k in range(0, total, _HASHES_AT_ONCE):
        spans = zip(starts[k : k + _HASHES_AT_ONCE], ends[k : k + _HASHES_AT_ONCE])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash (a hash of the text that tells rows of one id apart) and fingerprint (signed) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text, shingle) for text in texts_of(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fingerprint"]
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(compute, "doc_id long, text_hash long, fingerprint long")


class BKTree:
    """Values by Hamming distance: the child of a node under edge d is d bits away from it, and so is all below that edge."""

    def __init__(self, values: list[int]) -> None:
        self.values, self.parent = values, [-1] * len(values)
        self.children: list[dict[int, int]] = [{} for _ in values]
        self.left, self.here = [0] * len(values), [True] * len(values)  # values still below and at a node
        for k, value in enumerate(values):
            node = 0
            while k:
                edge = (value ^ values[node]).bit_count()
                child = self.children[node].get(edge)
                if child is None:
                    self.children[node][edge], self.parent[k] = k, node
                    break
                node = child
            while node >= 0 and k:
                self.left[node] += 1
                node = self.parent[node]
            self.left[k] += 1

    def take(self, value: int, radius: int) -> list[int]:
        """Remove and return the values within ``radius`` of ``value``; edges that lead only further away are not followed."""
        found, open_nodes = [], [0] if self.left and self.left[0] else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (value ^ self.values[node]).bit_count()
            if distance <= radius and self.here[node]:
                found.append(node)
            for edge, child in self.children[node].items():
                if distance - radius <= edge <= distance + radius and self.left[child]:
                    open_nodes.append(child)
        for node in found:
            self.here[node] = False
            while node >= 0:
                self.left[node] -= 1
                node = self.parent[node]
        return [self.values[node] for node in found]


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links (value, smallest value of its component) among ``values``."""
    links, tree = [], BKTree(values)
    for value in values:
        members = tree.take(value, 0)
        waiting = list(members)
        while waiting:
            near = tree.take(waiting.pop(), radius)
            members += near
            waiting += near
        root = min(members, default=None)
        links += [(member, root) for member in members if member != root]
    return links


@lru_cache(maxsize=None)
def _blocks(mask: int, radius: int) -> list[int]:
    """``mask`` joined with each of ``radius + 1`` blocks of the bits outside it."""
    free = [bit for bit in range(BITS) if not mask >> bit & 1]
    return [mask | sum(1 << int(bit) for bit in block) for block in np.array_split(free, radius + 1)]


def _split(rows: DataFrame, radius: int) -> DataFrame:
    """Each fingerprint once per block of the bits that its shard leaves open."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, values = (batch.column(name).to_numpy() for name in ("mask", "fingerprint"))
            for mask in np.unique(masks):
                own = values[masks == mask]
                for block in _blocks(int(mask) % (1 << BITS), radius):
                    block = np.uint64(block).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own & block), pa.array(own)], ["mask", "value", "fingerprint"])

    return rows.select("mask", "fingerprint").mapInArrow(deal, "mask long, value long, fingerprint long")


def _shards(distinct: DataFrame, radius: int) -> DataFrame:
    """(mask, value, fingerprint): shards that any two near fingerprints share one of, none larger than ``SHARD`` that can be split."""
    rows, done = _split(distinct.select(F.lit(0).cast("long").alias("mask"), "fingerprint"), radius), []
    fixed = 0
    while True:
        more = (BITS - fixed) // (radius + 1)
        fixed += more
        if not more or BITS - fixed <= SHARD.bit_length():  # distinct fingerprints of a shard are few by now
            break
        large = store(rows.groupBy("mask", "value").count().where(F.col("count") > SHARD).select("mask", "value"), "simhash-large")
        if large.isEmpty():
            break
        done.append(rows.join(large, ["mask", "value"], "left_anti"))
        rows = _split(rows.join(large, ["mask", "value"], "left_semi"), radius)
    for part in done:
        rows = rows.unionByName(part)
    return rows


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fingerprint`` at most ``radius`` bits apart."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        values: list[int] = []

        def ended() -> list[tuple[int, int]]:
            return forest(values, radius) if len(values) > 1 else []

        for batch in batches:
            out = []
            masks, names, prints = (batch.column(name).to_numpy() for name in ("mask", "value", "fingerprint"))
            cuts = np.flatnonzero((np.diff(masks) != 0) | (np.diff(names) != 0)) + 1
            unsigned = prints.view(np.uint64)
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(masks)]):
                if a == b:
                    continue
                if (shard := (masks[a], names[a])) != held:
                    out += ended()
                    held, values = shard, []
                values += unsigned[a:b].tolist()
            yield _pairs(out)
        yield _pairs(ended())

    def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    shards = _shards(distinct, radius).repartition("mask", "value").sortWithinPartitions("mask", "value")
    return shards.mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, text_hash, fingerprint (signed) and component_id of every row, and root, the component's smallest fingerprint."""
    printed = store(fingerprints(docs, shingle), "simhash-prints")
    distinct = store(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = connected_components(links(distinct, radius))
    rooted = distinct.join(roots.select(F.col("node").alias("fingerprint"), "root"), "fingerprint", "left")
    rooted = store(rooted.withColumn("root", F.coalesce("root", "fingerprint")), "simhash-roots")
    # Stored, so that the joins read one row per component from a table of their own and can split the rows of a large one.
    named = store(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-named")
    groups = rooted.select("fingerprint", "root").join(named, "root")
    return printed.join(groups, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, then the smallest hash of its text.

    A row without an id stays only in a component without any id.
    """
    found = store(near_duplicates(docs, shingle, radius), "simhash-found")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    best = store(found.groupBy("root").agg(F.min(place).alias("best")), "simhash-best")
    is_best = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    marked = found.join(best, "root").withColumn("kept", is_best)
    counted = store(marked.groupBy("doc_id", "text_hash", "kept").count(), "simhash-marked")
    dropped = counted.where("not kept").select("doc_id", "text_hash")
    repeated = counted.where("kept and count > 1").select("doc_id", "text_hash")
    kept = drop_rows(docs, dropped)
    if repeated.isEmpty():
        return kept
    once = fresh(docs, "_text_hash")
    marked = docs.withColumn(once, F.xxhash64(F.col("text").cast("string")))
    same = docs["doc_id"].cast("long").eqNullSafe(repeated["doc_id"]) & (F.col(once) == repeated["text_hash"])
    return drop_rows(kept, repeated).unionByName(marked.join(repeated, same, "left_semi").dropDuplicates(["doc_id", once]).drop(once))
