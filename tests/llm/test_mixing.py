from __future__ import annotations

import hashlib
import random
import re

import pytest

from ledgerlane.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, key string, _cut string, epochs string"
WEIGHTS = (5.0, 2.0, 1.0)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Shares of 150 % by weight; what is above a cap is shared again among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, left, open_names = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while open_names and left > 1e-9:
        level = left / sum(weight[s] for s in open_names)
        full = {s for s in open_names if target[s] + level * weight[s] >= 2 * sizes[s]}
        for s in open_names:
            target[s] = min(2.0 * sizes[s], target[s] + level * weight[s])
        left = 1.5 * sum(sizes.values()) - sum(target.values())
        open_names -= full
    return target


def plain_mix(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    target, out = plain_targets(sizes), []
    for name, total in sizes.items():
        epochs = int(target[name] / total + 1e-9) if total else 0
        rest, done, groups = target[name] - epochs * total, 0, {}
        for doc_id, text, source in rows:
            if source == name:
                spelled = f"0|{'' if doc_id is None else doc_id}|{hashlib.md5((text or '').encode()).hexdigest()}"
                groups.setdefault(hashlib.md5(spelled.encode()).hexdigest()[:15], []).append((doc_id, text))
        for key in sorted(groups):
            amount = sum(words(text) for _, text in groups[key])
            inside = rest > 1e-9 and (done + amount <= rest + 1e-6 or done + amount - rest < rest - done)
            done += amount
            out += [(doc_id, words(text), total, round(target[name], 4), words(text) * (epochs + inside)) for doc_id, text in groups[key]]
    return out


def key(row):
    return tuple(map(str, row))


def corpus(seed, n=300):
    rng = random.Random(seed)
    names = ["a", "b", "ä", "Z", None, "", "zz", "src1"]
    return [(k, " ".join("w" for _ in range(rng.randrange(60))) + rng.choice(["", " \t\n", "é"]), names[min(rng.randrange(12), 7)]) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "s", "k", "c", "e") for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("per_range", [4096, 10])
def test_equals_brute_force(spark, monkeypatch, per_range):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", per_range)
    rows = corpus(per_range)
    planned = mixing.mix(frame(spark, rows), WEIGHTS)
    found = [(r.doc_id, r.size, r.source_size, round(r.target, 4), r.taken) for r in mixing.taken_rows(planned).collect()]
    assert sorted(found, key=key) == sorted(plain_mix(rows), key=key)
    assert all(row[4] <= 2 * row[1] for row in found)


def test_the_mix_holds_each_row_as_often_as_it_is_taken(spark):
    rows = corpus(5)
    docs = frame(spark, rows)
    planned = mixing.mix(docs, WEIGHTS)
    mixed = mixing.apply_mix(docs, planned)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.taken_rows(planned).collect()}
    assert all(copies.get(i, 0) * size == amount for i, (size, amount) in taken.items())
    assert max(copies.values()) <= 2
    texts = {i: (t, s) for i, t, s in rows}
    assert all((r.text, r.source) == texts[r.doc_id] for r in mixed.collect())


def test_taken_words_come_near_the_target(spark):
    rows = [(k, "w " * (k % 50 + 1), f"s{min(k % 9, 4)}") for k in range(2000)]
    found = mixing.taken_rows(mixing.mix(frame(spark, rows), WEIGHTS)).groupBy("source_size", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] - r.target) <= 50 for r in found)


def test_reruns_agree(spark):
    runs = [sorted(map(tuple, mixing.taken_rows(mixing.mix(frame(spark, corpus(9)).repartition(n), WEIGHTS)).collect())) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_odd_rows(spark):
    rows = [(None, "a b", None), (None, None, None), (1, "", "x"), (2, "one two three", "x"), (2, "one two three", "x"), (3, "w " * 100_000, "y"), (4, None, "only empty")]
    docs = frame(spark, rows)
    planned = mixing.mix(docs, WEIGHTS)
    found = [(r.doc_id, r.size, r.source_size, round(r.target, 4), r.taken) for r in mixing.taken_rows(planned).collect()]
    assert sorted(found, key=key) == sorted(plain_mix(rows), key=key)
    for some in ([], [(1, None, None), (2, "", "b")]):
        docs = frame(spark, some)
        planned = mixing.mix(docs, WEIGHTS)
        assert [r.taken for r in mixing.taken_rows(planned).collect()] == [0] * len(some)
        assert mixing.apply_mix(docs, planned).count() == 0
