"""Token-ID output: flat unsigned integer files with 64-bit document offsets, read through a memory map.

A corpus is a folder with ``corpus.json`` and, per part:

``part-K.bin``  the token ids of the part's documents, one after the other, as little-endian uint16 (uint32 for larger vocabularies)
``part-K.idx``  n + 1 little-endian uint64: where each of its n documents starts in the whole corpus, and where the last ends
``part-K.doc``  n little-endian int64: the documents' ids, rows without an id first (their number is in ``corpus.json``)

Parts follow each other in ascending document id. Where a part starts in the corpus is the prefix sum of the parts' lengths,
known only when every part is written, so lengths are written first and turned into offsets in a second, small pass.

NULL text counts as empty: such a document holds the end id alone. Rows without an id come first. Repeated ids follow each
other in the order of a hash of their texts; equal rows are all kept. An empty table gives a corpus without parts. Columns
other than id and text are ignored.
"""

from __future__ import annotations

import json
import os
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.common import filesystem, replacing, ship
from ledgerlane.sources.publish import store

#: Largest tokenizer file sent to the executors.
TOKENIZER_BYTES = 64 << 20

_PARTS = "part int, documents long, unnamed long, tokens long"
_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


@dataclass(frozen=True)
class Corpus:
    """A written corpus. ``parts`` has one entry per file: (number, documents, unnamed documents, tokens, base)."""

    uri: str
    dtype: str
    end_id: int
    parts: tuple[tuple[int, int, int, int, int], ...]

    @staticmethod
    def load(uri: str) -> Corpus:
        files, root = filesystem(uri)
        with files.open_input_stream(f"{root}/corpus.json") as source:
            told = json.loads(source.read())
        return Corpus(uri, told["dtype"], told["end_id"], tuple(map(tuple, told["parts"])))

    def save(self) -> None:
        files, root = filesystem(self.uri)
        with replacing(files, f"{root}/corpus.json") as out:
            out.write(json.dumps({"dtype": self.dtype, "end_id": self.end_id, "parts": self.parts}).encode())


def _name(root: str, part: int, kind: str) -> str:
    return f"{root}/part-{part:06d}.{kind}"


def mapped(files: pa.fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """The numbers of a file: a memory map of a local file, the bytes of a remote one."""
    if isinstance(files, pa.fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype)


#: How byte-level vocabularies spell a space.
_BLANK = "\u0120"
#: Stand behind every text for its end id, and in front of words that no space precedes: the first one, those behind a line break, and punctuation.
_END, _FIRST, _LINE, _STOP = "\0", "\x01", "\x02", "\x03"
#: Punctuation between a letter and a space.
_STOPPED = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])([.,!?:;]) "


class Memory:
    """Ids of words, in two generations: when the younger holds half of what may be kept it becomes the older one, which goes.

    A word that is met again moves to the younger generation, so words in use stay and words met once go.
    """

    def __init__(self, kept: int) -> None:
        self.half, self.young, self.old = max(1, kept // 2), {}, {}

    def find(self, words: list[str]) -> tuple[list[bytes | None], list[int]]:
        """The ids of words, and the places of those that are not known."""
        found = list(map(self.young.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if not self.old:
            return found, missing
        unknown = []
        for k, ids in zip(missing, map(self.old.get, [words[k] for k in missing])):
            if ids is None:
                unknown.append(k)
            else:
                found[k] = self.young[words[k]] = ids
        return found, unknown

    def add(self, words: list[str], ids: list[bytes]) -> None:
        self.young.update(zip(words, ids))
        if len(self.young) > self.half:
            self.young, self.old = {}, self.young


class Encoder:
    """Encodes texts to the bytes of their ids, with the same ids as the tokenizer gives for whole texts.

    A byte-level tokenizer without a normalizer starts a new piece at every single space between two visible characters, so texts may be
    cut there, at single line breaks, and where letters end and punctuation begins. The distinct words of many texts are found at once, the ids of
    those met before are remembered, and the others go through the tokenizer by the thousand: a token that begins with a
    space begins a word. Ids are then dealt out by word number. Texts with other spaces or characters, and other
    tokenizers, get the whole text encoded.
    """

    _ODD = ("  ", "\n ", " \n", "<|")

    def __init__(self, model: str, dtype: str, remembered: int = 500_000, end: bytes = b"") -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        told = json.loads(model)
        pre = told.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        added = told.get("added_tokens") or []
        self.by_word = bool(plain) and told.get("normalizer") is None and all(t["content"].startswith("<|") for t in added)
        if sys.byteorder != "little":
            raise ValueError("the files are little-endian, this machine is not")
        self.tokenizer, self.dtype, self.end, self.memory = Tokenizer.from_str(model), np.dtype(dtype), end, Memory(remembered)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[number for token, number in vocabulary.items() if token.startswith(_BLANK)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(each.ids, self.dtype).tobytes() for each in found]

    def _cuttable(self, text: str) -> bool:
        odd = any(odd in text for odd in self._ODD) or text.strip() != text or not text
        return self.by_word and not odd and text.replace("\n", "").isprintable()

    def _new(self, words: list[str]) -> list[bytes]:
        """Ids of words behind a space, from texts of a thousand of them."""
        texts = [" " + " ".join(words[k : k + 1000]) for k in range(0, len(words), 1000)]
        ids = np.frombuffer(b"".join(self._encode(texts)), self.dtype)
        first = np.flatnonzero(self.begins[ids])
        if len(first) != len(words):  # a vocabulary that has no token for a space
            return self._encode([f" {word}" for word in words])
        width, raw = self.dtype.itemsize, ids.tobytes()
        bounds = [*(first * width).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        found, missing = self.memory.find(words)
        fronts = {_FIRST: "", _LINE: "\n", _STOP: ""}
        heads = [k for k in missing if words[k][0] in fronts]
        inner = [k for k in missing if words[k][0] not in fronts and words[k] != _END]
        lines = self._encode([fronts[words[k][0]] + words[k][1:] for k in heads])
        for places, ids in ((heads, lines), (inner, self._new([words[k] for k in inner]) if inner else [])):
            for k, each in zip(places, ids):
                found[k] = each
            self.memory.add([words[k] for k in places], ids)
        return [self.end if ids is None else ids for ids in found]

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of several texts in a row, each with the end id, and how many each text has."""
        lines = [text if "\n\n" in text else text.replace("\n", f" {_LINE}") for text in texts]
        marked = pa.array([f"{_FIRST}{text} {_END}" for text in lines], pa.large_string())
        rows = pc.split_pattern(pc.replace_substring_regex(marked, _STOPPED, rf"\1 {_STOP}\2 "), " ")
        coded = rows.flatten().dictionary_encode()
        number = coded.indices.to_numpy()
        # No word holds a space, so one text of them all comes back as a list in one step.
        words = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary.cast(pa.string()))
        each = self._ids(pc.binary_join(words, " ")[0].as_py().split(" "))
        size = np.fromiter(map(len, each), np.int64, len(each)) // self.dtype.itemsize
        start, amount = np.cumsum(size) - size, size[number]
        before = np.cumsum(amount) - amount
        place = np.arange(amount.sum()) + np.repeat(start[number] - before, amount)
        ids = np.frombuffer(b"".join(each), self.dtype)[place]
        return ids, np.add.reduceat(amount, rows.offsets.to_numpy()[:-1])

    def encode(self, texts: list[str]) -> tuple[bytes, np.ndarray]:
        """The ids of several texts in a row, as bytes, and the number of each text's ids; both with the end id behind every text."""
        if not texts:
            return b"", np.empty(0, np.int64)
        cut = [k for k, text in enumerate(texts) if self._cuttable(text)]
        ids, sizes = self._cut([texts[k] for k in cut]) if cut else (np.empty(0, self.dtype), np.empty(0, np.int64))
        if len(cut) == len(texts):
            return ids.tobytes(), sizes
        width, raw, found = self.dtype.itemsize, ids.tobytes(), dict.fromkeys(range(len(texts)))
        ends = (np.cumsum(sizes) * width).tolist()
        found.update((k, raw[a:b]) for k, a, b in zip(cut, [0, *ends], ends))
        whole = [k for k in found if found[k] is None]
        found.update((k, each + self.end) for k, each in zip(whole, self._encode([texts[k] for k in whole])))
        rows = list(found.values())
        return b"".join(rows), np.fromiter(map(len, rows), np.int64, len(rows)) // width


@lru_cache(maxsize=1)
def _encoder(model: str, dtype: str, end: bytes) -> Encoder:
    """One encoder per worker process, kept from task to task."""
    return Encoder(model, dtype, end=end)


def _together(texts: list[str], size: int = 2 << 20) -> Iterator[list[str]]:
    """Texts in groups of about ``size`` characters."""
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def write_corpus(docs: DataFrame, uri: str, tokenizer_path: str, end_id: int = 0) -> Corpus:
    """Encode every text of ``docs`` (doc_id, text) and write the corpus to the folder ``uri``.

    The rows are range-partitioned by id, one file per partition; ids are written chunk by chunk, so a task holds one
    Arrow batch. The tokenizer travels with the task, so executors need no file of it.
    """
    spark = docs.sparkSession
    ship(spark)
    if os.path.getsize(tokenizer_path) > TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer_path} is larger than {TOKENIZER_BYTES} bytes")
    with open(tokenizer_path, encoding="utf-8") as source:
        model = source.read()
    from tokenizers import Tokenizer

    dtype = "<u2" if max(Tokenizer.from_str(model).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    shared, end = spark.sparkContext.broadcast(model), np.array([end_id], dtype).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(shared.value, dtype, end)
        part, (files, root) = TaskContext.get().partitionId(), filesystem(uri)
        documents = unnamed = tokens = 0
        with (
            replacing(files, _name(root, part, "bin")) as ids,
            replacing(files, _name(root, part, "len")) as lengths,
            replacing(files, _name(root, part, "doc")) as names,
        ):
            for batch in batches:
                doc_ids = batch.column("doc_id")
                unnamed += doc_ids.null_count
                names.write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                for texts in _together([text or "" for text in batch.column("text").to_pylist()]):
                    row, size = encoder.encode(texts)
                    lengths.write(size.astype("<u8").tobytes())
                    ids.write(row)
                    documents, tokens = documents + len(texts), tokens + int(size.sum())
        if documents:
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32())}
                | {k: pa.array([v], pa.int64()) for k, v in (("documents", documents), ("unnamed", unnamed), ("tokens", tokens))}
            )

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    written = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, _PARTS)
    parts, base = [], 0
    for row in sorted(store(written, "token-parts").collect()):  # one row per file
        parts.append((*row, base))
        base += row.tokens
    corpus = Corpus(uri, dtype, end_id, tuple(parts))
    _offsets(spark, corpus)
    corpus.save()
    return corpus


def _per_part(spark: SparkSession, corpus: Corpus) -> DataFrame:
    """One row per part, each in a task of its own."""
    rows = spark.createDataFrame(list(corpus.parts), f"{_PARTS}, base long")
    return rows.repartitionByRange(max(1, len(corpus.parts)), "part")


def _offsets(spark: SparkSession, corpus: Corpus) -> None:
    """Turn the parts' lengths into offsets in the whole corpus."""
    uri = corpus.uri

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(uri)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = mapped(files, _name(root, row["part"], "len"), "<u8")
                ends = np.cumsum(lengths, dtype="<u8") + np.uint64(row["base"])
                with replacing(files, _name(root, row["part"], "idx")) as out:
                    out.write(np.array([row["base"]], "<u8").tobytes())
                    out.write(ends.tobytes())
            yield batch.select(["part"])

    if corpus.parts:
        _per_part(spark, corpus).mapInArrow(write, "part int").write.format("noop").mode("overwrite").save()


def read_corpus(spark: SparkSession, corpus: Corpus, rows_at_once: int = 4096) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the CRC-32 of its ids as little-endian uint32."""
    uri, dtype = corpus.uri, corpus.dtype

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(uri)
        for batch in batches:
            for row in batch.to_pylist():
                ids = mapped(files, _name(root, row["part"], "bin"), dtype)
                ends = mapped(files, _name(root, row["part"], "idx"), "<u8").astype("i8")
                names = mapped(files, _name(root, row["part"], "doc"), "<i8")
                for first in range(0, len(names), rows_at_once):
                    bounds = ends[first : first + rows_at_once + 1]
                    local = (bounds - row["base"]).tolist()
                    crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(local, local[1:])]
                    named = names[first : first + rows_at_once].astype("i8")
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(named, mask=np.arange(first, first + len(named)) < row["unnamed"]),
                            "start": pa.array(bounds[:-1]),
                            "n_tokens": pa.array(np.diff(bounds)),
                            "ids_crc32": pa.array(crcs, pa.int64()),
                        }
                    )

    if not corpus.parts:
        return spark.createDataFrame([], _ROWS)
    return _per_part(spark, corpus).mapInArrow(read, _ROWS)
