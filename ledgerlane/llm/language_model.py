"""Language-model scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark and read through memory maps.

Tokens are the words of a text with A-Z lower-cased, then one end; the first follows a begin that is no token itself. The model is a
folder of sorted hash arrays, cut into buckets by the first bits of a hash:

``words-B.hash``, ``.count``    hashes of the bucket's words, ascending, and how often each occurs; a word's id is its place over all buckets
``words-B.followers``           per word, how many different words follow it once, twice, and more often, and how many stand before it
``pairs-B.hash``, ``.count``    mixed ids of the bucket's pairs of neighbours, ascending, and their counts in a byte
``pairs-B.large``               (place, count) of the pairs with a count of ``LARGE`` or more

Counting takes two passes over the training texts: words, then pairs of word ids. Tasks sum what they meet, and send it packed and sorted
to the bucket it belongs to, where it is summed again; a word or pair that makes up a third of the corpus is one entry of each task.
What follows and precedes a word is summed over the pair buckets in the same way. The driver sees one row per bucket.

p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + (D1 N1(v) + D2 N2(v) + D3 N3(v)) / c(v) * p(w), and p(w) is the same over the numbers of different
words before w, mixed with 1 / (V + 1), so that unseen words have a share. A discount that the counts of counts do not define (small
corpora) is half its count. Behind a word that was never seen p(w | v) is p(w). The bound of the format is 2^32 - 2 different words.

NULL and empty texts are one end token. Rows without an id are in no fold: they are trained on and not held out. Repeated rows count each
time. Without training texts all tokens have probability 1. An empty table gives no rows. Other columns are ignored. Texts are read in
slices, so a very long one needs no more than its hashes (8 bytes a word).
"""

from __future__ import annotations

import json
import re
import shutil
import tempfile
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.common import filesystem, mixed, replacing, ship, texts_of
from ledgerlane.llm.counting import SUMMED, Tally, pack, starts, summed, tally, unpack
from ledgerlane.llm.token_files import mapped
from ledgerlane.llm.tokens import Words
from ledgerlane.sources.publish import store

#: Entries of one packed row.
ROW = 1 << 17
#: Bytes of text handled at once.
CHUNK = 6 << 20
#: Counts from here on do not fit the byte of a pair.
LARGE = 255
#: The id of the begin. Ids of words are smaller.
BEGIN = 0xFFFFFFFF

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_END = xxhash.xxh3_64_intdigest(b"\n")  # no word has a line break
_PACKED = "bucket int, data binary"
_PAIR, _FOLLOWERS, _BEFORE = ("<u8", "<u8"), ("<u4", "<u4", "<u4", "<u4"), ("<u4", "<u4")


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``CHUNK`` bytes that end at white space."""
    start = 0
    while len(text) - start > CHUNK:
        cut = _SPACE.search(text, start + CHUNK)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def tokens(texts: list[bytes]) -> Words:
    """The hashed tokens of several texts, each with its end."""
    hash_of, parts, ends, total = xxhash.xxh3_64_intdigest, [], [], 0
    for text in texts:
        for piece in _slices(text.translate(_LOWER)):
            parts.append(np.fromiter(map(hash_of, piece.split()), np.uint64))
            total += len(parts[-1])
        parts.append(np.array([_END], np.uint64))
        total += 1
        ends.append(total)
    return Words(np.concatenate(parts) if parts else np.empty(0, np.uint64), np.array(ends, np.int64))


def _grouped(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in groups of about ``CHUNK`` bytes."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > CHUNK:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def _sent(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed rows) with the order inside a bucket kept."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = starts(bucket)
    for start, end in zip(at, np.append(at[1:], len(bucket))):
        for first in range(start, end, ROW):
            rows = order[first : min(end, first + ROW)]
            yield int(bucket[start]), pack(*(column[rows] for column in columns))


def _rows(sent: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for bucket, data in sent:
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([data], pa.binary())], ["bucket", "data"])


def _merged(batches: Iterator[pa.RecordBatch], kinds: tuple[str, ...]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Per bucket of a task the distinct keys of its packed rows and their sums; the rows come sorted by bucket."""
    bucket, held, pending = None, None, []

    def together() -> list[np.ndarray]:
        parts = ([held] if held else []) + pending
        return list(summed(*(np.concatenate(column) for column in zip(*parts))))

    for batch in batches:
        for row, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
            if row != bucket:
                if bucket is not None:
                    yield bucket, together()
                bucket, held, pending = row, None, []
            pending.append(unpack(data.as_py(), kinds))
            if sum(len(part[0]) for part in pending) > SUMMED:
                held, pending = together(), []
    if bucket is not None:
        yield bucket, together()


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _name(root: str, kind: str, bucket: int, column: str) -> str:
    return f"{root}/{kind}-{bucket:06d}.{column}"


def _write(files: pa.fs.FileSystem, path: str, values: np.ndarray) -> None:
    with replacing(files, path) as out:
        out.write(np.ascontiguousarray(values).tobytes())


def discounts(of_counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more from the numbers of entries with counts 1 to 4."""
    n1, n2, n3, n4 = of_counts
    share = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    found = [k - (k + 1) * share * more / less if less and more else k / 2 for k, less, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(value if 0 < value < k else k / 2 for k, value in enumerate(found, 1))


@dataclass(frozen=True)
class Model:
    """A counted model. ``bases``: the id of the first word of each bucket, and the number of words V last."""

    uri: str
    bits: int
    bases: tuple[int, ...]
    tokens: int
    documents: int
    begins: tuple[int, int, int]
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_followers: tuple[int, int, int]

    @property
    def words(self) -> int:
        return self.bases[-1]

    def save(self) -> None:
        files, root = filesystem(self.uri)
        with replacing(files, f"{root}/model.json") as out:
            out.write(json.dumps(asdict(self)).encode())

    @staticmethod
    def load(uri: str) -> Model:
        files, root = filesystem(uri)
        with files.open_input_stream(f"{root}/model.json") as source:
            told = json.loads(source.read())
        return Model(**{name: tuple(value) if isinstance(value, list) else value for name, value in told.items()})


class Arrays:
    """The files of a model as memory maps; those of a remote folder are copied to the worker's own disk first."""

    def __init__(self, uri: str) -> None:
        self.files, self.root = filesystem(uri)
        self.copies = None if isinstance(self.files, pa.fs.LocalFileSystem) else tempfile.mkdtemp(prefix="ledgerlane-model-")
        self.open = lru_cache(maxsize=8192)(self._open)

    def _open(self, kind: str, bucket: int, column: str, dtype: str) -> np.ndarray:
        path, files = _name(self.root, kind, bucket, column), self.files
        if self.copies:
            local = _name(self.copies, kind, bucket, column)
            with files.open_input_stream(path) as source, open(local, "wb") as out:
                shutil.copyfileobj(source, out)
            path, files = local, pa.fs.LocalFileSystem()
        return mapped(files, path, dtype)

    def places(self, kind: str, bits: int, hashes: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """Per bucket that distinct ascending ``hashes`` touch: (bucket, their slice, places in the bucket's array, whether they are there)."""
        at = _bucket(hashes, bits)
        first = starts(at)
        for start, end in zip(first, np.append(first[1:], len(at))):
            bucket, here = int(at[start]), hashes[start:end]
            known = self.open(kind, bucket, "hash", "<u8")
            place = np.minimum(np.searchsorted(known, here), max(len(known) - 1, 0))
            there = known[place] == here if len(known) else np.zeros(len(here), bool)
            yield bucket, slice(start, end), place, there

    def ids(self, model: Model, hashes: np.ndarray) -> np.ndarray:
        """Ids of distinct ascending hashes; -1 for words that the model does not know."""
        found = np.full(len(hashes), -1, np.int64)
        for bucket, rows, place, there in self.places("words", model.bits, hashes):
            found[rows] = np.where(there, place + model.bases[bucket], -1)
        return found

    def words(self, model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, counts and (N1, N2, N3, before) of distinct ascending hashes; zeros for words that the model does not know."""
        ids, counts, around = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes)), np.zeros((len(hashes), 4))
        for bucket, rows, place, there in self.places("words", model.bits, hashes):
            ids[rows] = np.where(there, place + model.bases[bucket], -1)
            if there.any():
                counts[rows] = np.where(there, self.open("words", bucket, "count", "<u8")[place], 0)
                followers = self.open("words", bucket, "followers", "<u4").reshape(-1, 4)
                around[rows] = np.where(there[:, None], followers[place], 0)
        return ids, counts, around

    def pairs(self, model: Model, keys: np.ndarray) -> np.ndarray:
        """Counts of distinct ascending mixed pairs."""
        counts = np.zeros(len(keys))
        for bucket, rows, place, there in self.places("pairs", model.bits, keys):
            if there.any():
                small = np.where(there, self.open("pairs", bucket, "count", "u1")[place], 0).astype(float)
                many = np.flatnonzero(small == LARGE)
                if len(many):
                    large = self.open("pairs", bucket, "large", "<u8").reshape(-1, 2)
                    small[many] = large[np.searchsorted(large[:, 0], place[many]), 1]
                counts[rows] = small
        return counts


@lru_cache(maxsize=2)
def _arrays(uri: str) -> Arrays:
    """One set of maps per worker process and model; a model's folder is never written again."""
    return Arrays(uri)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the place of each element's value among them."""
    order = np.argsort(values)
    ordered = values[order]
    at = starts(ordered)
    where = np.empty(len(values), np.int64)
    where[order] = np.repeat(np.arange(len(at)), np.diff(at, append=len(values)))
    return ordered[at], where


def _before(ids: np.ndarray, words: Words, begin: int) -> np.ndarray:
    """For each token what stands before it; ``begin`` for the first of a text."""
    left = np.roll(ids, 1)
    left[words.ends - words.counts] = begin
    return left


def _to_buckets(sent: DataFrame, bits: int) -> DataFrame:
    """Packed rows at the task of their bucket, bucket by bucket."""
    return sent.repartitionById(1 << bits, F.col("bucket")).sortWithinPartitions("bucket")


def _count_words(texts: DataFrame, uri: str, bits: int) -> DataFrame:
    """Writes the words' hashes and counts; (bucket, words, tokens)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Tally()

        def send() -> Iterator[pa.RecordBatch]:
            keys, counts = met.take()
            yield from _rows(_sent(_bucket(keys, bits), keys, counts))

        for batch in batches:
            for group in _grouped(texts_of(batch.column("text"))):
                if met.add(tokens(group).hashes):
                    yield from send()
        yield from send()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(uri)
        for bucket, (keys, counts) in _merged(batches, _PAIR):
            _write(files, _name(root, "words", bucket, "hash"), keys)
            _write(files, _name(root, "words", bucket, "count"), counts)
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array([bucket], pa.int32()), "words": pa.array([len(keys)]), "tokens": pa.array([int(counts.sum())])}
            )

    return _to_buckets(texts.mapInArrow(count, _PACKED), bits).mapInArrow(write, "bucket int, words long, tokens long")


def _count_pairs(texts: DataFrame, model: Model) -> DataFrame:
    """Writes the pairs; (kind, bucket, data): what each pair bucket saw around the words, and its totals in JSON."""
    uri, bits = model.uri, model.bits
    bases = np.array(model.bases[:-1], np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, arrays = Tally(), _arrays(uri)

        def send() -> Iterator[pa.RecordBatch]:
            keys, counts = met.take()
            yield from _rows(_sent(_bucket(mixed(keys), bits), keys, counts))

        for batch in batches:
            for group in _grouped(texts_of(batch.column("text"))):
                words = tokens(group)
                known, where = _distinct(words.hashes)
                ids = arrays.ids(model, known)[where].astype(np.uint64)
                if met.add(_before(ids, words, BEGIN) << np.uint64(32) | ids):
                    yield from send()
        yield from send()

    def around(kind: str, ids: np.ndarray, *values: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
        owner = np.searchsorted(bases, ids.astype(np.int64), "right") - 1
        for bucket, data in _sent(owner, ids, *(value.astype(np.uint32) for value in values)):
            yield kind, bucket, data

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(uri)
        for bucket, (keys, counts) in _merged(batches, _PAIR):
            hashes = mixed(keys)
            order = np.argsort(hashes)
            _write(files, _name(root, "pairs", bucket, "hash"), hashes[order])
            small = np.minimum(counts[order], LARGE).astype(np.uint8)
            large = np.flatnonzero(small == LARGE)
            _write(files, _name(root, "pairs", bucket, "count"), small)
            _write(files, _name(root, "pairs", bucket, "large"), np.stack([large.astype(np.uint64), counts[order][large]], 1))
            left, at = keys >> np.uint64(32), starts(keys >> np.uint64(32))
            met = [np.add.reduceat(test.astype(np.int64), at) for test in (counts == 1, counts == 2, counts > 2)]
            begin = left[at] == BEGIN
            rows = [*around("followers", left[at][~begin].astype(np.uint32), *(value[~begin] for value in met))]
            rows += around("before", *tally((keys & np.uint64(BEGIN)).astype(np.uint32)))
            totals = {"pairs": len(keys), "of_counts": [int((counts == k).sum()) for k in (1, 2, 3, 4)], "begins": [int(v[begin].sum()) for v in met]}
            rows.append(("totals", bucket, json.dumps(totals).encode()))
            for kind, where, data in rows:
                yield pa.RecordBatch.from_pydict({"kind": [kind], "bucket": pa.array([where], pa.int32()), "data": pa.array([data], pa.binary())})

    sent = _to_buckets(texts.mapInArrow(count, _PACKED), bits)
    return sent.mapInArrow(write, f"kind string, {_PACKED}")


def _write_followers(seen: DataFrame, model: Model) -> DataFrame:
    """Writes what stands around the words of each bucket; (bucket, numbers of words with 1, 2, 3, 4 and with 3 or more before them)."""
    uri, bases = model.uri, model.bases

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(uri)
        bucket, found = None, None

        def done() -> pa.RecordBatch:
            _write(files, _name(root, "words", bucket, "followers"), found.astype("<u4"))
            before = found[:, 3]
            numbers = [int((before == k).sum()) for k in (1, 2, 3, 4)] + [int((before > 2).sum())]
            return pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "numbers": pa.array([numbers], pa.list_(pa.int64()))})

        for batch in batches:
            for kind, row, data in zip(batch.column("kind").to_pylist(), batch.column("bucket").to_pylist(), batch.column("data")):
                if row != bucket:
                    if bucket is not None:
                        yield done()
                    bucket, found = row, np.zeros((bases[row + 1] - bases[row], 4), np.int64)
                ids, *values = unpack(data.as_py(), _FOLLOWERS if kind == "followers" else _BEFORE)
                first = 0 if kind == "followers" else 3
                found[ids.astype(np.int64) - bases[row], first : first + len(values)] += np.stack(values, 1)
        if bucket is not None:
            yield done()

    return _to_buckets(seen, model.bits).mapInArrow(write, "bucket int, numbers array<long>")


def train(docs: DataFrame, uri: str, usable: Column | None = None) -> Model:
    """Count the texts of ``docs`` (those that are ``usable``) into the folder ``uri``.

    There are as many buckets as shuffle partitions, rounded up to a power of two, so their size follows the session's setting.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = (docs if usable is None else docs.where(usable)).select(F.col("text").cast("string").alias("text"))
    bits = max(int(spark.conf.get("spark.sql.shuffle.partitions")) - 1, 0).bit_length()
    sizes = {row.bucket: row for row in store(_count_words(texts, uri, bits), "words").collect()}  # one row per bucket
    files, root = filesystem(uri)
    bases = [0]
    for bucket in range(1 << bits):
        bases.append(bases[-1] + (sizes[bucket].words if bucket in sizes else 0))
        if bucket not in sizes:
            for column in ("hash", "count", "followers"):
                _write(files, _name(root, "words", bucket, column), np.empty(0, np.uint64))
    if bases[-1] >= BEGIN:
        raise ValueError(f"{bases[-1]} different words; the format holds {BEGIN - 1}")
    total = sum(row.tokens for row in sizes.values())
    nothing = Model(uri, bits, tuple(bases), total, 0, (0, 0, 0), 0, (0.5, 1.0, 1.5), (0.5, 1.0, 1.5), (0, 0, 0))
    if not total:
        nothing.save()
        return nothing
    seen = store(_count_pairs(texts, nothing), "pairs")
    told = {row.bucket: json.loads(row.data) for row in seen.where("kind = 'totals'").collect()}  # one row per bucket
    for bucket in set(range(1 << bits)).difference(told):
        for column in ("hash", "count", "large"):
            _write(files, _name(root, "pairs", bucket, column), np.empty(0, np.uint64))
    numbers = np.zeros(5, np.int64)
    for row in store(_write_followers(seen.where("kind != 'totals'"), nothing), "followers").collect():  # one row per bucket
        numbers += np.array(row.numbers)
    numbers = numbers.tolist()
    model = Model(
        uri,
        bits,
        tuple(bases),
        total,
        texts.count(),
        tuple(map(sum, zip(*(t["begins"] for t in told.values())))),
        sum(t["pairs"] for t in told.values()),
        discounts([sum(column) for column in zip(*(t["of_counts"] for t in told.values()))]),
        discounts(numbers[:4]),
        (numbers[0], numbers[1], numbers[4]),
    )
    model.save()
    return model


def _taken_off(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discounts; 0 stays 0."""
    return counts - np.array([0.0, *by])[np.minimum(counts, 3).astype(np.int64)]


def log_probabilities(model: Model, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: its count in the training texts, the log10 of its add-one probability, and that of its Kneser-Ney probability."""
    arrays = _arrays(model.uri)
    distinct, where = _distinct(words.hashes)
    ids, counts, around = arrays.words(model, distinct)
    base = np.log10((counts + 1) / (model.tokens + model.words + 1))
    if not model.tokens:
        return counts[where], base[where], np.zeros(len(where))
    rest = np.dot(model.word_discounts, model.word_followers) / model.pairs / (model.words + 1)
    alone = _taken_off(around[:, 3], model.word_discounts) / model.pairs + rest
    # The begin is a context behind the last word.
    total = np.append(counts, model.documents)
    held = np.vstack([around[:, :3], model.begins]) @ np.array(model.pair_discounts)
    left = _before(where, words, len(distinct))
    key = np.append(ids, BEGIN)[left].astype(np.uint64) << np.uint64(32) | ids[where].astype(np.uint64)
    both = np.flatnonzero((np.append(ids, 0)[left] >= 0) & (ids[where] >= 0))
    pairs, at = _distinct(mixed(key[both]))
    together = np.zeros(len(where))
    together[both] = arrays.pairs(model, pairs)[at]
    context = total[left]
    seen = context > 0
    size = np.where(seen, context, 1)
    share = _taken_off(together, model.pair_discounts) / size + np.where(seen, held[left] / size, 1.0) * alone[where]
    return counts[where], base[where], np.log10(share)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the text) and perplexity of every row."""
    ship(docs.sparkSession)
    columns = "doc_id long, n_tokens long, n_known long, base_score double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column("doc_id"), 0
            for group in _grouped(texts_of(batch.column("text"))):
                words = tokens(group)
                known, base, full = log_probabilities(model, words)
                owner, n = words.owner, len(group)
                found = [
                    ids.slice(at, n),
                    pa.array(words.counts),
                    pa.array(np.bincount(owner[known > 0], minlength=n)),
                    pa.array(np.bincount(owner, weights=base, minlength=n)),
                    pa.array(np.bincount(owner, weights=full, minlength=n)),
                ]
                yield pa.RecordBatch.from_arrays(found, [name.split()[0] for name in columns.split(", ")])
                at += n

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return rows.mapInArrow(score, columns).withColumns({"train_tokens": F.lit(model.tokens).cast("long"), "perplexity": perplexity})


def corpus_perplexity(scored: DataFrame) -> float:
    """Perplexity of all scored texts together."""
    score, count = scored.agg(F.sum("score"), F.sum("n_tokens")).first()
    return 10 ** (-score / count) if count else float("nan")
