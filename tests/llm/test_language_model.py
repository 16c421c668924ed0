from __future__ import annotations

import math
import random
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlane.llm import language_model as lm
from ledgerlane.llm.common import mixed
from ledgerlane.llm.tokens import Words
from ledgerlane.sources.publish import scratch

SCHEMA = "doc_id long, text string, score string, bucket string, n_tokens string"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return [*(text or "").encode().translate(LOWER).split(), b"\n"]


def plain_discounts(of_counts):
    n1, n2, n3, n4 = of_counts
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    found = [0.0]
    for k, less, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4)):
        d = k - (k + 1) * y * more / less if less and more else k / 2
        found.append(d if 0 < d < k else k / 2)
    return found


class Plain:
    """The model in dictionaries."""

    def __init__(self, texts):
        rows = [words_of(text) for text in texts]
        self.count = Counter(word for row in rows for word in row)
        self.tokens, self.words = sum(self.count.values()), len(self.count)
        self.pairs = Counter(pair for row in rows for pair in zip([b""] + row, row))
        self.context, self.followers, self.before = Counter(), defaultdict(lambda: [0, 0, 0, 0]), Counter()
        for (left, right), n in self.pairs.items():
            self.context[left] += n
            self.followers[left][min(n, 3)] += 1
            self.before[right] += 1
        numbers = [[sum(v == k for v in table.values()) for k in (1, 2, 3, 4)] for table in (self.pairs, self.before)]
        self.d2, self.d1 = map(plain_discounts, numbers)

    def alone(self, word):
        rest = sum(self.d1[min(n, 3)] for n in self.before.values()) / len(self.pairs)
        n = self.before[word]
        return (n - self.d1[min(n, 3)]) / len(self.pairs) + rest / (self.words + 1)

    def probability(self, left, word):
        if not self.context[left]:
            return self.alone(word)
        n = self.pairs[left, word]
        rest = sum(d * f for d, f in zip(self.d2, self.followers[left]))
        return (n - self.d2[min(n, 3)]) / self.context[left] + rest / self.context[left] * self.alone(word)

    def row(self, doc_id, text):
        row = words_of(text)
        base = sum(math.log10((self.count[w] + 1) / (self.tokens + self.words + 1)) for w in row)
        score = sum(math.log10(self.probability(*pair)) for pair in zip([b""] + row, row)) if self.tokens else 0.0
        return doc_id, len(row), sum(self.count[w] > 0 for w in row), self.tokens, base, score


def usable():
    return ~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def plainly_usable(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def scored(spark, rows, parts=4, select=usable):
    docs = spark.createDataFrame([(*row, "a", "b", "c") for row in rows], SCHEMA).repartition(parts)
    model = lm.train(docs, scratch(spark, f"lm-{uuid.uuid4().hex}"), select())
    found = lm.score_documents(docs, model).collect()
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found), key=repr), model


def same(found, want):
    want = sorted(want, key=repr)
    assert [row[:4] for row in found] == [row[:4] for row in want]
    assert np.allclose([row[4:] for row in found], [row[4:] for row in want], rtol=1e-11, atol=1e-11)


def drawn(seed, documents=300):
    draw, vocabulary = random.Random(seed), [f"w{k}" for k in range(120)] + ["É", "Straße", "THE", "the"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(k, " ".join(draw.choices(vocabulary, weights, k=draw.randint(0, 60)))) for k in range(documents)]


def test_equals_dictionaries(spark):
    rows = drawn(1)
    model = Plain([text for doc_id, text in rows if plainly_usable(doc_id)])
    same(scored(spark, rows)[0], [model.row(*row) for row in rows])


def test_partitions_sums_and_long_texts_do_not_matter(spark, monkeypatch):
    """Counts taken early, packed rows cut short, and texts read in slices."""
    rows = drawn(2) + [(1000, "the w1 " * 40_000), (1001, "x" * 70_000)]
    want = scored(spark, rows)[0]
    monkeypatch.setattr(lm, "CHUNK", 1 << 12)
    cut = lm.tokens([rows[-2][1].encode(), b"", b"a" * 9000])
    assert cut.counts.tolist() == [80_001, 1, 2]
    same(scored(spark, rows, parts=11)[0], want)


def test_probabilities_of_all_words_add_up_to_one(spark):
    rows = drawn(3)
    plain = Plain([text for _, text in rows])
    _, model = scored(spark, rows, select=lambda: F.lit(True))
    known = [word for word in plain.count if word != b"\n"]
    for left in (known[0], known[-1], b"never-seen"):
        texts = [left + b" " + word for word in [*known, b"unseen-word"]]
        _, _, logs = lm.log_probabilities(model, lm.tokens(texts))
        ends = np.cumsum([3] * len(texts)) - 1
        total = (10 ** logs[ends - 1]).sum() + 10 ** lm.log_probabilities(model, lm.tokens([left]))[2][1]
        assert abs(total - 1) < 1e-9


def test_counts_above_a_byte(spark):
    rows = [(k, "very common pair " * 40) for k in range(20)] + [(100, "rare pair")]
    plain = Plain([text for _, text in rows])
    same(scored(spark, rows, select=lambda: F.lit(True))[0], [plain.row(*row) for row in rows])


def test_nulls_repeats_and_rows_without_id(spark):
    rows = [(None, "a b"), (None, None), (3, None), (3, ""), (3, "A a b \x0b\x1c c"), (3, "A a b \x0b\x1c c"), (5, "  \n\t ")]
    plain = Plain([text for doc_id, text in rows if plainly_usable(doc_id)])
    same(scored(spark, rows)[0], [plain.row(*row) for row in rows])


def test_nothing_to_learn_from(spark):
    found, model = scored(spark, [(1, "a b"), (2, None)], select=lambda: F.lit(False))
    assert found == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)] and model.words == 0


def test_empty_table(spark):
    assert scored(spark, [])[0] == []


def test_a_saved_model_is_the_model(spark):
    _, model = scored(spark, drawn(4, 40))
    assert lm.Model.load(model.uri) == model


def test_copies_of_remote_arrays(spark, tmp_path):
    _, model = scored(spark, drawn(5, 40))
    words = lm.tokens([b"w0 w1 w2 never", b"the w0"])
    want = lm.log_probabilities(model, words)
    remote = lm.Arrays(model.uri)
    remote.copies = str(tmp_path)
    known = np.unique(words.hashes)
    assert (remote.ids(model, known) == lm.Arrays(model.uri).ids(model, known)).all() and any(tmp_path.iterdir())
    assert len(want[2]) == len(words.hashes)


def test_held_out_texts_are_less_surprising_than_by_word_counts(spark):
    rows = drawn(6, 600)
    draw = random.Random(9)
    rows = [(k, " ".join(word for w in text.split() for word in (w, f"{w}-follows" if draw.random() < 0.9 else "other"))) for k, text in rows]
    out = [row for row in scored(spark, rows)[0] if not plainly_usable(row[0])]
    assert out and sum(row[5] for row in out) > 0.8 * sum(row[4] for row in out)


@pytest.mark.parametrize("kinds", [("<u8", "<u8"), ("<u4", "<u4", "<u4", "<u4"), ("<u4", "<u4")])
def test_packed_columns_come_back(kinds):
    columns = [np.arange(1000).astype(kind) * 7 for kind in kinds]
    assert all((a == b).all() for a, b in zip(lm.unpack(lm.pack(*columns), kinds), columns))


def test_windows_and_buckets():
    hashes = np.sort(mixed(np.arange(1000)))
    assert (np.diff(lm._bucket(hashes, 5)) >= 0).all() and lm._bucket(hashes, 0).max() == 0
    left = lm._before(np.array([5, 6, 7, 8]), Words(np.zeros(4, np.uint64), np.array([1, 4])), 99)
    assert left.tolist() == [99, 99, 6, 7]
