"""Quality rules: simple counts, and a log-likelihood ratio of hashed n-grams between trusted text and the raw corpus.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets, counted over all trusted documents and over all documents.
A document's score is the mean, over its n-grams, of the log of the bucket's count in trusted text over the count that its share of the
raw corpus lets expect there, both smoothed by ``SMOOTHING``; the mean makes long and short documents comparable. Counts are integers, so the scores do not depend on how the rows were dealt out.
A document is kept if the base rules hold and its score is at least ``threshold``.

NULL and empty texts have no words: all counts are 0, the score is 0 and the base rules fail. Rows without an id are never
trusted. A repeated row counts each time. Without trusted documents all scores are 0. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import chunks, mixed, small, texts_of
from ledgerlane.llm.tokens import Words, hashed

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
#: Added to a bucket's trusted and expected counts, so rare n-grams say little in a small corpus.
SMOOTHING = 10.0
#: Mean log ratio below which a document is unlike the trusted ones.
THRESHOLD = -0.1
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"

_COLUMNS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs, and the text each belongs to."""
    owner, pairs = words.owner, words.windows(2)
    shift = np.uint64(64 - BUCKET_BITS)
    single = mixed(words.hashes) >> shift
    double = words.seeds((0, 1), pairs) >> shift
    return np.concatenate([single, double]).astype(np.int64), np.concatenate([owner, owner[pairs]])


def repeated_words(words: Words) -> np.ndarray:
    """Per text, the words in windows of ``WINDOW`` words that occur in it twice or more."""
    places = words.windows(WINDOW)
    owner = words.owner
    keys = words.seeds(tuple(range(WINDOW)), places) ^ mixed(owner[places].astype(np.uint64) + np.uint64(1))
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words.hashes) + WINDOW + 1, np.int64)
    repeated = places[times[which] > 1]
    np.add.at(covered, repeated, 1)
    np.add.at(covered, repeated + WINDOW, -1)
    inside = np.cumsum(covered)[: len(words.hashes)] > 0
    return np.bincount(owner[inside], minlength=len(words.ends))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def _count(rows: DataFrame) -> DataFrame:
    """(bucket, raw, trusted) per bucket; each task sends one row per bucket it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            marks = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            base = 0
            for part in chunks(texts_of(batch.column("text"))):
                found, owner = buckets(hashed([text.split() for text in part]))
                raw += np.bincount(found, minlength=BUCKETS)
                trusted += np.bincount(found[marks[base : base + len(part)][owner]], minlength=BUCKETS)
                base += len(part)
        met = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(raw[met]), pa.array(trusted[met])], ["bucket", "raw", "trusted"])

    return rows.mapInArrow(count, "bucket long, raw long, trusted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def log_ratios(docs: DataFrame, trusted_ids: DataFrame) -> np.ndarray:
    """Per bucket the log of its trusted over its expected count, from all rows of ``docs``; at most ``BUCKETS`` rows come back."""
    named = small(trusted_ids.select(F.col("doc_id").cast("long").alias("_trusted")).where("_trusted IS NOT NULL").distinct())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(named, F.col("doc_id") == F.col("_trusted"), "left").select("text", F.col("_trusted").isNotNull().alias("trusted"))
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in _count(rows).collect():
        raw[row.bucket], trusted[row.bucket] = row.raw, row.trusted
    if not trusted.any():
        return np.zeros(BUCKETS)
    expected = raw * (trusted.sum() / raw.sum())
    return np.log((trusted + SMOOTHING) / (expected + SMOOTHING))


def score_documents(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, score, base_failed and kept of every row."""
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, trusted_ids))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            ids, base = batch.column("doc_id"), 0
            for part in chunks(texts_of(batch.column("text"))):
                words = hashed([text.split() for text in part])
                found, owner = buckets(words)
                total = np.bincount(owner, weights=table[found], minlength=len(part))
                grams = np.bincount(owner, minlength=len(part))
                columns = [
                    ids.slice(base, len(part)),
                    pa.array(words.counts),
                    pa.array([len(text.decode("utf-8", "replace")) - sum(map(text.count, SPACE)) for text in part], pa.int64()),
                    pa.array([len(text) - len(text.translate(None, SYMBOLS)) for text in part], pa.int64()),
                    pa.array([repeated_lines(text) for text in part], pa.int64()),
                    pa.array(repeated_words(words)),
                    pa.array(total / np.maximum(grams, 1)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [name.split()[0] for name in _COLUMNS.split(", ")])
                base += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    found = rows.mapInArrow(score, _COLUMNS).withColumn("base_failed", failed)
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
