"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network with a calibrated temperature.

Every word has an index vector, a few +1 and -1 at places that follow from the word's hash, and a context vector, the sum of the index vectors
of its neighbours in all documents, which needs no labels; its word vector is the sum of both, each scaled to length 1. The
shape of a word (its kind of first letter and of its last three characters) is a word of a second text, read the same way. A document's
features are the means of its word vectors and of its shape vectors, the lengths of both means and the mean products of neighbouring vectors (large if
words repeat), and its length. A network with
one hidden layer is fitted on a bounded sample of labelled documents, a part of which is set aside to fit the temperature that
divides its output before the logistic curve.

NULL and empty texts have zero vectors and a score like any other. Without labels of both classes every score is the share of label 1
(0.5 without labels). Rows without an id are scored and are not held out. A repeated row is scored each time. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import chunks, mixed, ship, texts_of
from ledgerlane.llm.counting import pack, starts, unpack
from ledgerlane.llm.tokens import Words, hashed
from ledgerlane.llm.training import held_out, labelled_sample

#: Training bound of the network: documents a class.
DOCUMENTS = 2500
#: Parts of the context table that are summed apart, so a task that sums holds one of them.
BLOCKS = 64
#: Words and shapes are hashed to this many vectors.
BUCKET_BITS = 15
BUCKETS, DIMENSIONS, NONZERO, REACH = 1 << BUCKET_BITS, 32, 4, 2
HIDDEN, EPOCHS, RATE, DECAY = 24, 400, 0.01, 1e-3
#: Share of the sample set aside for the temperature.
ASIDE = 0.2

_SHAPE = bytes(
    ord("a") if c >= 128 or chr(c).islower() else ord("A") if chr(c).isupper() else ord("0") if chr(c).isdigit() else c for c in range(256)
)


def index_vectors() -> np.ndarray:
    """Per bucket a vector of zeros with ``NONZERO`` entries of +1 or -1 (summed where they meet)."""
    table = np.zeros((BUCKETS, DIMENSIONS), np.int32)
    rows = np.arange(BUCKETS)
    for k in range(NONZERO):
        drawn = mixed(rows.astype(np.uint64) * np.uint64(NONZERO) + np.uint64(k + 1))
        np.add.at(table, (rows, (drawn % np.uint64(DIMENSIONS)).astype(np.int64)), np.where(drawn >> np.uint64(63), 1, -1))
    return table


_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def shapes(texts: list[bytes]) -> Words:
    """The shapes of the texts' words, hashed: kinds of the first and of the last three bytes, found in one buffer of all texts."""
    letters = np.frombuffer(b"".join(text + b"\n" for text in texts).translate(_SHAPE), np.uint8)
    inside = ~_BLANK[letters]
    edges = np.flatnonzero(np.diff(inside, prepend=False))  # every text ends with a blank, so starts and ends alternate
    begin, end = edges[::2], edges[1::2]
    code = letters[begin].astype(np.uint64)
    for back in (3, 2, 1):
        code = code << np.uint64(8) | np.where(end - begin >= back, letters[np.maximum(end - back, 0)], 0).astype(np.uint64)
    limits = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return Words(mixed(code + np.uint64(1)), np.searchsorted(begin, limits))


def read(texts: list[bytes]) -> tuple[Words, Words]:
    """The words of the texts, and their shapes."""
    return hashed([text.split() for text in texts]), shapes(texts)


def bucket(words: Words) -> np.ndarray:
    return (mixed(words.hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def contexts(words: Words, index: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Per bucket the sum of the index vectors of its neighbours within ``REACH`` words, added to ``table``."""
    table = np.zeros((BUCKETS, DIMENSIONS), np.int64) if table is None else table
    own, owner = bucket(words), words.owner
    if not len(own):
        return table
    rows = index.astype(np.int16)[own]
    around = np.zeros_like(rows)
    for step in range(1, REACH + 1):
        near = (owner[:-step] == owner[step:]).astype(np.int16)[:, None]
        around[:-step] += rows[step:] * near
        around[step:] += rows[:-step] * near
    order = np.argsort(own.astype(np.uint16), kind="stable")
    head = starts(own[order])
    table[own[order[head]]] += np.add.reduceat(around[order], head, axis=0, dtype=np.int64)
    return table


def gather_contexts(docs: DataFrame, index: np.ndarray) -> np.ndarray:
    """The context vectors of all words and shapes of ``docs``: a table of fixed size a task, summed block by block in Spark."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, some = np.zeros((BUCKETS, DIMENSIONS), np.int64), False
        for batch in batches:
            for part in chunks(texts_of(batch.column("text"))):
                for words in read(part):
                    contexts(words, index, table)
                    some = some or len(words.hashes) > 0
        parts = table.reshape(BLOCKS, -1) if some else table[:0]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts)), pa.int32()), pa.array([pack(part) for part in parts], pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch.column("block").to_pylist(), batch.column("sums")):
                (part,) = unpack(sums.as_py(), ("<i8",))
                found[block] = found.get(block, 0) + part
        sums = pa.array([part.tobytes() for part in found.values()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), sums], ["block", "sums"])

    told = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(gather, "block int, sums binary")
    table = np.zeros((BLOCKS, BUCKETS // BLOCKS * DIMENSIONS), np.int64)
    for row in told.repartitionById(BLOCKS, F.col("block")).mapInArrow(add, "block int, sums binary").collect():  # 8 MB in all
        table[row.block] = np.frombuffer(row.sums, "<i8")
    return table.reshape(BUCKETS, DIMENSIONS)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Features of each text."""
    parts = []
    for words in read(texts):
        counts, found = words.counts, np.zeros((len(texts), DIMENSIONS))
        full, rows, owner = np.flatnonzero(counts), vectors[bucket(words)], words.owner
        if len(full):
            found[full] = np.add.reduceat(rows, (words.ends - counts)[full], axis=0, dtype=np.float64)
        found /= np.maximum(counts, 1)[:, None]
        pairs = np.flatnonzero(owner[:-1] == owner[1:])
        products = np.einsum("nd,nd->n", rows[pairs], rows[pairs + 1], dtype=np.float64)
        near = np.bincount(owner[pairs], weights=products, minlength=len(texts)) / np.maximum(counts - 1, 1)
        parts += [found, np.linalg.norm(found, axis=1, keepdims=True), near[:, None]]
    return np.hstack([*parts, np.log1p(counts)[:, None]])


@dataclass(frozen=True)
class Model:
    """Word vectors, the features' centre and scale, the two layers, and the temperature."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        first, shift, second, offset = self.layers
        return np.maximum((features - self.centre) / self.scale @ first + shift, 0) @ second + offset

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -50, 50)))


def fit_network(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Both layers, by Adam over all rows at once from a fixed start."""
    rng = np.random.default_rng(0)
    found = [rng.normal(0, rows.shape[1] ** -0.5, (rows.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    mean, square = ([np.zeros_like(each) for each in found] for _ in range(2))
    weight = weight / weight.sum()
    for epoch in range(1, EPOCHS + 1):
        first, shift, second, offset = found
        hidden = np.maximum(rows @ first + shift, 0)
        wrong = weight * (1 / (1 + np.exp(-np.clip(hidden @ second + offset, -50, 50))) - labels)
        back = wrong[:, None] * second * (hidden > 0)
        slopes = [rows.T @ back + DECAY * first, back.sum(axis=0), hidden.T @ wrong + DECAY * second, np.array([wrong.sum()])]
        for k, slope in enumerate(slopes):
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.999 * square[k] + 0.001 * slope * slope
            found[k] = found[k] - RATE * (mean[k] / (1 - 0.9**epoch)) / (np.sqrt(square[k] / (1 - 0.999**epoch)) + 1e-8)
    return found[0], found[1], found[2], float(found[3][0])


def fit_temperature(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The temperature of smallest weighted log loss, from a fixed grid."""
    grid = np.geomspace(0.25, 8, 61)
    losses = [np.sum(weight * np.logaddexp(0, np.where(labels == 1, -logits, logits) / t)) for t in grid]
    return float(grid[int(np.argmin(losses))]) if len(logits) else 1.0


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, kept_back: int = 2, documents: int = DOCUMENTS) -> Model:
    """Fit on at most ``documents`` labelled documents a class outside the fold kept back."""
    ship(docs.sparkSession)
    sample, totals = labelled_sample(docs, labels, "quality", folds, kept_back, documents)
    sample = sample.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    index = index_vectors()
    n_features = 2 * (DIMENSIONS + 2) + 1
    if sample.select("label").distinct().count() < 2:
        share = totals.get(1, 0) / (sum(totals.values()) or 1) if totals else 0.5
        flat = (np.zeros((n_features, 1)), np.zeros(1), np.zeros(1), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
        return Model(_unit(index).astype(np.float32), np.zeros(n_features), np.ones(n_features), flat)

    found = gather_contexts(docs, index)
    vectors = (_unit(index) + _unit(found)).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ours = texts_of(batch.column("text"))
            rows = np.vstack([pooled(part, shared.value) for part in chunks(ours)]) if ours else np.zeros((0, n_features))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(rows), pa.list_(pa.float64()))], ["label", "features"])

    seen = sorted((row.features, row.label) for row in sample.mapInArrow(pool, "label int, features array<double>").collect())
    rows, label = np.array([features for features, _ in seen]), np.array([value for _, value in seen])
    size = {value: max(1, int((label == value).sum())) for value in (0, 1)}
    weight = np.where(label == 1, totals[1] / size[1], totals[0] / size[0])
    aside = np.zeros(len(rows), bool)
    aside[np.random.default_rng(1).permutation(len(rows))[: int(ASIDE * len(rows))]] = True
    centre, scale = rows[~aside].mean(axis=0), rows[~aside].std(axis=0) + 1e-6
    layers = fit_network((rows[~aside] - centre) / scale, label[~aside], weight[~aside])
    model = Model(vectors, centre, scale, layers)
    return Model(vectors, centre, scale, layers, fit_temperature(model.logits(rows[aside]), label[aside], weight[aside]))


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.7, folds: int = 4, kept_back: int = 2) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = 0
            for part in chunks(texts_of(batch.column("text"))):
                found = shared.value.score(pooled(part, shared.value.vectors))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(base, len(part)), pa.array(found)], ["doc_id", "score"])
                base += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(score, "doc_id long, score double")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return found.select("doc_id", held_out(F.col("doc_id"), folds, kept_back).alias("held_out"), "score", predicted.alias("predicted"))
