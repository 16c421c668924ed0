from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from ledgerlane.llm import quality_classifier as qc
from ledgerlane.llm.tokens import hashed

DOCS, LABELS = "doc_id long, text string, score string, label string, features string", "doc_id long, quality int, toxic int"


def corpus(seed, n):
    rng = random.Random(seed)
    syllables = "the an re in er on at en ed or ti he st ou nd ar le ma so po".split()
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choices(syllables, k=rng.choice([1, 1, 2, 3]))) for _ in range(rng.randrange(10, 120))]
        good = rng.random() < 0.7
        if not good:
            kind = rng.randrange(3)
            words = [w + "%%%" for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1 else [w for w in words[:5] for _ in range(20)]
        rows.append((k, " ".join(words), "s", "l", "f"))
        labels.append((k, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_calibration(spark):
    rows, labels = corpus(1, 1200)
    docs, told = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    found = {r.doc_id: r for r in qc.score_documents(docs.repartition(3), qc.train(docs, told)).collect()}
    assert all(found[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k in found)
    held = [(found[k], good) for k, good, _ in labels if found[k].held_out]
    assert np.mean([r.predicted == good for r, good in held]) > 0.95
    assert abs(np.mean([r.score for r, _ in held]) - np.mean([good for _, good in held])) < 0.06


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows, labels = corpus(2, 300)
    docs = spark.createDataFrame(rows, DOCS)
    turned = [(k, 1 - good if zlib.crc32(str(k).encode()) % 4 == 2 else good, t) for k, good, t in labels]
    first, second = (qc.train(docs, spark.createDataFrame(told, LABELS)) for told in (labels, turned))
    assert all((a == b).all() for a, b in zip(first.layers[:3], second.layers[:3])) and first.temperature == second.temperature


def test_contexts_equal_brute_force():
    texts = [[b"a", b"b", b"c", b"a"], [], [b"b"], [b"a", b"a"]]
    words, index = hashed(texts), qc.index_vectors()
    own, base, expected = qc.bucket(words).tolist(), 0, np.zeros((qc.BUCKETS, qc.DIMENSIONS), np.int64)
    for row in texts:
        for i in range(len(row)):
            for j in range(len(row)):
                if 0 < abs(i - j) <= qc.REACH:
                    expected[own[base + i]] += index[own[base + j]]
        base += len(row)
    assert (qc.contexts(words, index) == expected).all()


def test_features_do_not_depend_on_neighbours():
    vectors = np.random.default_rng(0).normal(size=(qc.BUCKETS, qc.DIMENSIONS)).astype(np.float32)
    texts = [b"", b"one", b"One two, three", b" \n ", b"last last last"]
    together = qc.pooled(texts, vectors)
    assert np.allclose(together, np.vstack([qc.pooled([text], vectors) for text in texts]))
    assert (together[0] == together[3]).all()


def test_temperature_softens_an_overconfident_network():
    rng = np.random.default_rng(0)
    logits = rng.normal(0, 2, 4000)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-logits))).astype(int)
    assert qc.fit_temperature(3 * logits, labels, np.ones(4000)) == pytest.approx(3, rel=0.15)


def test_odd_rows(spark):
    rows, labels = corpus(3, 200)
    odd = [(None, "some text", *"slf"), (1000, None, *"slf"), (1001, "", *"slf"), (1002, "w" * 300_000, None, None, None), (1003, "a b " * 60_000, *"slf"), (5, "twice", *"slf")]
    docs = spark.createDataFrame(rows + odd, DOCS)
    told = spark.createDataFrame(labels + [(None, 1, 1), (1000, None, None), (1001, 0, 0), (7, 0, 0), (7, 1, 1)], LABELS)
    found = qc.score_documents(docs, qc.train(docs, told)).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == 206 and all(0 <= r.score <= 1 for r in found)
    assert by_id[1000].score == by_id[1001].score and not by_id[None].held_out
    assert qc.score_documents(docs.limit(0), qc.train(docs.limit(0), told)).collect() == []
    flat = qc.score_documents(docs, qc.train(docs, told.limit(0))).collect()
    assert {round(r.score, 6) for r in flat} == {0.5}


def test_shapes_are_those_of_the_words():
    texts = [b"", b" ", "Élan, co-op 1234 X\n\tyes! a".encode(), b"end", b"One one ONE oNe"]
    found = qc.shapes(texts)
    assert found.counts.tolist() == [len(text.split()) for text in texts]
    told = [word[:1] + b" " + word[-3:] for text in texts for word in text.translate(qc._SHAPE).split()]
    assert {(a == b) for a, b in zip(np.equal.outer(found.hashes, found.hashes).ravel(), [x == y for x in told for y in told])} == {True}
