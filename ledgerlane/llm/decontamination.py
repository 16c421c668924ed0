"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits in lower case; in scripts that are written without spaces every letter is a word. A mask looks at some positions of a window and ignores the others, so a
substituted word there leaves the hash as it is; windows of documents and benchmark items with equal hashes under a mask are hits. Around a hit
both texts are laid on the hit's diagonal and runs are taken in which a substituted word costs four matching ones; one counts if
it spans ``least`` words, or the whole item if that is shorter. At most a fifth of the words of such a run differ. The masks hit every counting run of 12 to
20 words with up to four substitutions (tested).

The benchmark is the query set: it is taken in blocks of bounded size, each sent to all tasks and held against every document.

NULL and empty texts have no words and match nothing. Items of fewer words than a mask spans must occur word for word. Those of
fewer than ``shortest`` are not searched, as ordinary prose has them: ``short_items`` names them, and ``shortest=1`` searches all. Items of equal words are one, named by the smallest id; items
without an id count among them but are named only if no other is (NULL). Repeated documents are reported each. Either table may be
empty. Other columns are ignored by ``overlaps`` and pass through ``drop_contaminated`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import chunks, drop_rows, ship, texts_of
from ledgerlane.llm.tokens import Words, hashed
from ledgerlane.sources.publish import store

#: Positions that count (1) and that are ignored (0).
MASKS = ("110110111011", "111010110111", "101111001111", "111100001111")
#: Words of an item that tell more than ordinary prose.
SHORTEST = 5
LEAST = 12
#: Benchmark words in one block, on average: four 8-byte seeds and a hash each, about 80 MB in a task.
BLOCK_WORDS = 1_000_000
#: What a substituted word costs, in matching words.
COST = 4

_OTHER = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))

_HITS = "doc_id long, text_hash long, item_id long, n_items long, doc_start long, doc_end long, item_start long, matched long"


#: Thai, Lao, Tibetan, Burmese, Khmer, Kana, Han; none of their letters has a byte below this one.
_UNSPACED = re.compile("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_BELOW = bytes(range(0xE0))


def words_of(text: bytes) -> list[bytes]:
    plain = text.decode("utf-8", "replace").lower()
    if not text.isascii() and text.translate(None, _BELOW):
        plain = _UNSPACED.sub(r" \1 ", plain)
    return plain.encode().translate(_OTHER).split()


@dataclass(frozen=True)
class Block:
    """Some benchmark items as arrays: their words, per mask the sorted seeds with the word each starts at, and per length below that of a mask the
    sorted hashes of whole items with the item each is."""

    item_ids: list[int | None]
    n_items: list[int]
    words: Words
    seeds: list[tuple[tuple[int, ...], np.ndarray, np.ndarray]]
    whole: list[tuple[int, np.ndarray, np.ndarray]]

    @staticmethod
    def build(items: list[tuple[int | None, int, list[bytes]]]) -> Block:
        words = hashed([row for _, _, row in items])
        offsets = [tuple(k for k, c in enumerate(mask) if c == "1") for mask in MASKS]
        span = max(map(len, MASKS))
        counts, starts = words.counts, words.ends - words.counts
        seeds, whole = [], []
        for mask, positions in zip(MASKS, offsets):
            places = words.windows(len(mask))
            keys = words.seeds(positions, places)
            order = np.argsort(keys, kind="stable")
            seeds.append(((len(mask), *positions), keys[order], places[order]))
        for size in range(1, span):  # items that a mask may not fit into
            if len(short := np.flatnonzero(counts == size)):
                keys = words.seeds(tuple(range(size)), starts[short])
                order = np.argsort(keys, kind="stable")
                whole.append((size, keys[order], short[order]))
        return Block([i for i, _, _ in items], [n for _, n, _ in items], words, seeds, whole)

    def contained(self, words: Words) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, place, words) of the first time each short item stands in a document word for word."""
        for size, keys, items in self.whole:  # items of equal words are one, so keys are distinct
            own = words.windows(size)
            hashes = words.seeds(tuple(range(size)), own)
            found = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = np.flatnonzero(keys[found] == hashes)
            if len(hit):
                doc, item = words.owner[own[hit]], items[found[hit]]
                _, first = np.unique(np.stack([doc, item]), axis=1, return_index=True)
                begin = words.ends - words.counts
                yield from ((int(doc[k]), int(item[k]), int(own[hit[k]] - begin[doc[k]]), size) for k in first)

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``words`` and in the block with equal seeds."""
        mine, theirs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for (size, *positions), keys, places in self.seeds:
            own = words.windows(size)
            hashes = words.seeds(tuple(positions), own)
            first = np.searchsorted(keys, hashes)
            hit = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == hashes) if len(keys) else np.empty(0, np.int64)
            first, last = first[hit], np.searchsorted(keys, hashes[hit], "right")
            times = last - first
            run = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            mine.append(np.repeat(own[hit], times))
            theirs.append(places[np.repeat(first, times) + run])
        return np.concatenate(mine), np.concatenate(theirs)


def best_run(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and matches of the run with the most matches less ``COST`` per mismatch; of equals the longest of those that end last."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -COST))])
    gain = score - np.minimum.accumulate(score)
    end = len(equal) - int(np.argmax(gain[::-1]))
    start = int(np.argmin(score[: end + 1]))
    return start, end, int(equal[start:end].sum())


def all_runs(equal: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Start, end and matches of the best run, and of the best ones beside it, that span ``least`` words."""
    parts = [(0, len(equal))]
    while parts:
        first, last = parts.pop()
        if last - first < least:
            continue
        start, end, matched = best_run(equal[first:last])
        if end - start >= least:
            yield first + start, first + end, matched
        if matched:
            parts += [(first, first + start), (first + end, last)]


def _overlaps(words: Words, block: Block, least: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(document, item, start and end in the document, start in the item, matches) of the best run per document and item."""
    told = list(block.contained(words))
    exact = {(d, i) for d, i, *_ in told}
    yield from ((d, i, place, place + size, 0, size) for d, i, place, size in told)
    mine, theirs = block.hits(words)
    if not len(mine):
        return
    doc, item = np.searchsorted(words.ends, mine, "right"), np.searchsorted(block.words.ends, theirs, "right")
    doc_start, item_start = words.ends - words.counts, block.words.ends - block.words.counts
    shift = (mine - doc_start[doc]) - (theirs - item_start[item])
    best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for d, i, diagonal in np.unique(np.stack([doc, item, shift]), axis=1).T.tolist():
        n, m = int(words.counts[d]), int(block.words.counts[i])
        first, last = max(0, -diagonal), min(m, n - diagonal)
        a, b = int(doc_start[d]) + diagonal, int(item_start[i])
        equal = words.hashes[a + first : a + last] == block.words.hashes[b + first : b + last]
        for start, end, matched in all_runs(equal, min(least, m)):
            run = (matched, -(first + start + diagonal), first + end + diagonal, first + start)
            best[d, i] = max(best.get((d, i), run), run)
    for (d, i), (matched, begin, end, item_begin) in best.items():
        if (d, i) not in exact:
            yield d, i, -begin, end, item_begin, matched


def _items(benchmark: DataFrame) -> DataFrame:
    """Items of equal words as one: item_id, n_items, words (joined by a space), n_words."""

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [words_of(text) for text in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([b" ".join(row).decode() for row in rows]), pa.array([len(row) for row in rows], pa.int64())],
                ["item_id", "words", "n_words"],
            )

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(normal, "item_id long, words string, n_words long")
    return rows.groupBy("words", "n_words").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))


def _blocks(benchmark: DataFrame, shortest: int) -> Iterator[Block]:
    """The items of ``shortest`` words and more, in blocks of about ``BLOCK_WORDS`` words."""
    items = store(_items(benchmark).where(F.col("n_words") >= shortest), "benchmark-items")
    total = items.agg(F.sum("n_words")).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_WORDS))
    for number in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("words"), F.lit(n_blocks)) == number).orderBy("item_id", "words").collect()
        if own:
            yield Block.build([(r.item_id, r.n_items, r.words.encode().split()) for r in own])


def short_items(benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(item_id, n_items, words, n_words) of the items that a search with ``shortest`` leaves out; items without a word match nothing at all."""
    return _items(benchmark).where((F.col("n_words") < shortest) & (F.col("n_words") > 0))


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, shortest: int = SHORTEST) -> DataFrame:
    """One row per document and item that share a passage: places count in words, ends are exclusive.

    doc_id, text_hash (tells rows of one id apart), item_id, n_items, doc_start, doc_end, item_start, matched.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = spark.createDataFrame([], _HITS)
    for own in _blocks(benchmark, max(1, shortest)):
        block = spark.sparkContext.broadcast(own)

        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            told = block.value
            for batch in batches:
                ids, hashes, out, base = batch.column("doc_id"), batch.column("text_hash"), [], 0
                for part in chunks(texts_of(batch.column("text"))):
                    for d, i, *run in _overlaps(hashed([words_of(each) for each in part]), told, least):
                        out.append((ids[base + d].as_py(), hashes[base + d].as_py(), told.item_ids[i], told.n_items[i], *run))
                    base += len(part)
                names = [name.split()[0] for name in _HITS.split(", ")]
                yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], pa.schema([(name, pa.int64()) for name in names]))

        found = found.unionByName(rows.mapInArrow(search, _HITS))
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` without the documents that share a passage with an item."""
    return drop_rows(docs, overlaps(docs, benchmark, least, shortest).select("doc_id", "text_hash"))
