from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlane.llm import token_files as tf
from ledgerlane.sources.publish import scratch

SCHEMA = "doc_id long, text string, start long, part string"
PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = tf.Encoder(open(PATH, encoding="utf-8").read(), "<u2")


def ids(text: str | None) -> list[int]:
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def written(spark, rows, path=PATH, end_id=0):
    frame = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], SCHEMA).repartition(5)
    return tf.write_corpus(frame, scratch(spark, "test-tokens"), path, end_id)


def expected(rows):
    out, start = [], 0
    for doc_id, text in rows:
        own = ids(text)
        out.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    return out


def test_round_trip_in_ascending_order(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(k * 7 - 100, f"Text {k}, words\nand more {k * k}! " * (k % 9)) for k in range(200)] + [(3000, None), (3001, ""), (3002, " x  <|endoftext|>\té")]
    corpus = written(spark, rows)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tf.Corpus.load(corpus.uri) == corpus and len(corpus.parts) > 1
    found = [tuple(r) for r in tf.read_corpus(spark, corpus, rows_at_once=7).orderBy("doc_id").collect()]
    assert found == expected(rows)


def test_files_hold_what_the_format_says(spark):
    rows = [(k, f"document {k} " * k) for k in range(40)]
    corpus = written(spark, rows)
    root = corpus.uri.removeprefix("file:")
    stream, base = [], 0
    for part, documents, unnamed, tokens, begin in corpus.parts:
        offsets = np.fromfile(f"{root}/part-{part:06d}.idx", "<u8")
        own = np.fromfile(f"{root}/part-{part:06d}.bin", "<u2")
        assert begin == base == offsets[0] and offsets[-1] == base + tokens and len(offsets) == documents + 1 and unnamed == 0
        stream, base = stream + own.tolist(), base + tokens
    assert stream == [i for _, text in rows for i in ids(text)]


def test_odd_rows(spark):
    rows = [(None, "no id"), (None, None), (5, "twice"), (5, "twice"), (5, "other"), (9, "word" * 30_000), (10, "a b " * 50_000)]
    found = tf.read_corpus(spark, written(spark, rows)).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, 5, 5, 5, 9, 10]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == sorted((str(i), n, c) for i, _, n, c in expected(rows))
    starts, sizes = [r.start for r in found], [r.n_tokens for r in found]
    assert starts == [sum(sizes[:k]) for k in range(len(sizes))]
    empty = written(spark, [])
    assert empty.parts == () and tf.read_corpus(spark, tf.Corpus.load(empty.uri)).collect() == []


def test_other_tokenizers_and_end_ids(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    other, rows = Tokenizer.from_file(path), [(k, f"Some, text {k}") for k in range(5)]
    corpus = written(spark, rows, path, end_id=70_000)
    assert corpus.dtype == "<u4"
    found = tf.read_corpus(spark, corpus).orderBy("doc_id").collect()
    for (_, text), row in zip(rows, found):
        own = [*other.encode(text, add_special_tokens=False).ids, 70_000]
        assert (row.n_tokens, row.ids_crc32) == (len(own), zlib.crc32(np.array(own, "<u4").tobytes()))


PIECES = st.lists(st.text(alphabet=st.sampled_from(list("abZÉß×·.#'!9 \n\t\x1c\x85 　🙂́<|>")), max_size=10) | st.just("<|endoftext|>") | st.text(max_size=6), max_size=6)


@settings(max_examples=800, deadline=None)
@given(PIECES, st.sampled_from([" ", "\n", ""]))
def test_encoding_by_words_equals_whole_texts(pieces, joint):
    text = joint.join(pieces)
    found = np.frombuffer(ENCODER.encode([text])[0], "<u2").tolist()
    assert found == TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("remembered", [0, 50])
def test_forgetting_words_changes_nothing(remembered):
    encoder = tf.Encoder(open(PATH, encoding="utf-8").read(), "<u2", remembered)
    for k in range(30):
        text = f"word{k}, and word{k % 5}. "
        assert np.frombuffer(encoder.encode([text.strip()])[0], "<u2").tolist() == TOKENIZER.encode(text.strip()).ids
