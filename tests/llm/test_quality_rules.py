from __future__ import annotations

import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlane.llm import quality_rules as rules
from ledgerlane.llm.tokens import hashed

SCHEMA = "doc_id long, text string, score string, kept string, _trusted string"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n_dup = sum(line in lines[:k] for k, line in enumerate(lines))
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), n_dup, len(inside), failed


def plain_scores(texts, trusted):
    """Bucket counts in dictionaries, n-gram by n-gram."""

    def grams(text):
        words = hashed([text.encode().split()])
        found, _ = rules.buckets(words)
        return found.tolist()

    raw, good = {}, {}
    for text, mark in zip(texts, trusted):
        for gram in grams(text):
            raw[gram] = raw.get(gram, 0) + 1
            good[gram] = good.get(gram, 0) + mark
    total, total_good = sum(raw.values()), sum(good.values())
    if not total_good:
        return [0.0] * len(texts)
    c = rules.SMOOTHING
    return [
        sum(math.log((good[g] + c) / (raw[g] * total_good / total + c)) for g in grams(text)) / max(1, len(grams(text))) for text in texts
    ]


def corpus(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = [f"w{min(int(rng.expovariate(0.02)), 300)}" for _ in range(rng.randrange(80))]
        if k % 4 == 0:
            words = [w + "###" for w in words]
        if k % 5 == 0 and words:
            words += words[:30] * 2
        text = "".join(w + rng.choice([" ", "\n", "\t", " \n", "é "]) for w in words)
        rows.append((k, text + rng.choice(["", "\n\nline\nline\n \n", "<b>|x|"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "k", "t") for i, t in rows], SCHEMA)


def test_equals_brute_force(spark):
    rows = corpus(1)
    trusted = [i % 4 != 0 and i % 3 == 0 for i, _ in rows]
    ids = spark.createDataFrame([(i,) for (i, _), mark in zip(rows, trusted) if mark] + [(None,), (10**9,), (3,)], "doc_id long")
    found = {r.doc_id: r for r in rules.score_documents(frame(spark, rows).repartition(5), ids).collect()}
    scores = plain_scores([t for _, t in rows], trusted)
    for (i, text), score in zip(rows, scores):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(text)
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= rules.THRESHOLD)


def test_scores_do_not_depend_on_partitions(spark):
    rows = corpus(2)
    ids = spark.createDataFrame([(i,) for i, _ in rows if i % 3 == 0], "doc_id long")
    runs = [sorted(map(tuple, rules.score_documents(frame(spark, rows).repartition(n), ids).collect())) for n in (1, 6)]
    assert runs[0] == runs[1]


def test_odd_rows(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "w " * 100_000), (6, "x" * 200_000)]
    none = spark.createDataFrame([], "doc_id long")
    found = rules.score_documents(frame(spark, rows), none).collect()
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.base_failed)) for r in found) == sorted(
        str((i, *plain_counts(t)[:4], plain_counts(t)[5])) if i != 5 else str((5, 100_000, 100_000, 0, 0, True)) for i, t in rows
    )
    assert all(r.score == 0 and not r.kept for r in found)
    assert rules.score_documents(frame(spark, rows).limit(0), none).collect() == []


def test_word_hashes_are_those_of_the_library():
    assert hashed([[b"abc"]]).hashes.tolist() == [xxhash.xxh3_64_intdigest(b"abc")]


def test_verdicts_on_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    trusted = labels.where("quality = 1 AND doc_id % 2 = 0")
    found = rules.score_documents(docs, trusted).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed")
    kept = {r.quality: r.share for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.1
