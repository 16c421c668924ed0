from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from ledgerlane.llm import toxicity as tox

DOCS, LABELS = "doc_id long, text string, score string, label string, _id string", "doc_id long, quality int, toxic int"
INSULTS = ["zorgle", "fribbut", "quonker", "plimsot"]


def plain_vector(word):
    """All subsequences of the bordered word, by trying all places."""
    letters, found = [0, *(c - 96 for c in word), 0], {}
    for places in itertools.combinations(range(len(letters)), tox.ORDER):
        if places[-1] - places[0] < tox.SPAN:
            key = tuple(letters[p] for p in places)
            found[key] = found.get(key, 0) + tox.DECAY ** (places[-1] - places[0] + 1 - tox.ORDER)
    return found


def plain_kernel(a, b):
    a, b = plain_vector(a), plain_vector(b)
    dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
    return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5


def test_kernel_equals_brute_force():
    words = [b"a", b"ab", b"idiot", b"idxiot", b"banana", b"bananas", b"zzzzzz", b"{{{a", b"moron"]
    found = tox.kernel(words, words)
    assert found == pytest.approx(np.array([[plain_kernel(a, b) for b in words] for a in words]), abs=1e-5)


def test_units():
    assert tox.units(b"Some WORDS, i d i o t and id-iot x y 12 ok!") == {b"some", b"words", b"idiot", b"i", b"d", b"o", b"t", b"and", b"x", b"y", b"ok"}
    assert tox.units(b"") == set() and tox.units(b" \n 12 ...") == set()
    long = tox.units(b"q" * 30 + b"zorgle" + b"r" * 40)
    assert all(len(unit) <= tox.LONGEST for unit in long) and any(b"zorgle" in unit for unit in long)


def corpus(seed, n):
    rng = random.Random(seed)
    syllables = "the an re in er on at en ed or ti he st ou nd ar le ma so po".split()
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choices(syllables, k=rng.choice([1, 1, 2, 2, 3]))) for _ in range(rng.randrange(20, 80))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.randrange(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        text = "".join(w + rng.choice([" ", " ", " ", " ", ". "]) for w in words)
        rows.append((k, text, "s", "l", "i"))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_misspelt_insults(spark):
    rows, labels = corpus(1, 900)
    docs, told = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    model = tox.train(docs, told)
    found = {r.doc_id: r for r in tox.score_documents(docs.repartition(3), model).collect()}
    assert all(found[k].held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k in found)
    right = [found[k].predicted == bad for k, _, bad in labels if found[k].held_out]
    assert sum(right) / len(right) > 0.95
    one, two = ("the man red {} star and so {} on the port".format(*p) for p in (("zor-gle", "quoonker"), ("z o r g l e", "fribxbut")))
    clean = "the man red one star and so many on the port"
    scores = tox.Scorer(model).decide([one.encode(), two.encode(), clean.encode()])[:, :2]
    assert scores[0].min() > 0 and scores[1].min() > 0 and scores[2].max() < 0


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows, labels = corpus(2, 400)
    docs = spark.createDataFrame(rows, DOCS)
    turned = [(k, q, 1 - bad if zlib.crc32(str(k).encode()) % 3 == 1 else bad) for k, q, bad in labels]
    first, second = (tox.train(docs, spark.createDataFrame(told, LABELS)) for told in (labels, turned))
    assert (first.table == second.table).all() and first.curve == second.curve and first.bias == second.bias


def test_odd_rows(spark):
    rows, labels = corpus(3, 300)
    odd = [(None, "zorgle quonker", *"sli"), (1000, None, *"sli"), (1001, "", *"sli"), (1002, "12 %%", None, None, None), (1003, "zorgle fribbut " * 20_000, *"sli"), (5, "twice", *"sli")]
    docs = spark.createDataFrame(rows + odd, DOCS)
    told = spark.createDataFrame(labels + [(None, 1, 1), (1000, None, None), (1001, 1, 0), (7, 1, 0), (7, 1, 1)], LABELS)
    found = tox.score_documents(docs, tox.train(docs, told)).collect()
    by_id = {r.doc_id: r for r in found if r.doc_id is None or r.doc_id >= 1000}
    assert len(found) == 306 and all(0 <= r.score <= 1 for r in found)
    assert by_id[None].predicted == by_id[1003].predicted == 1 and not by_id[None].held_out
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score < 0.5
    kept = tox.drop_toxic(docs, told)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in found)
    assert tox.score_documents(docs.limit(0), tox.train(docs.limit(0), told)).collect() == []


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(k, 1, 0) for k in range(300)]])
def test_without_both_classes_all_scores_are_the_share(spark, labels):
    docs = spark.createDataFrame(corpus(4, 50)[0], DOCS)
    scores = {r.score for r in tox.score_documents(docs, tox.train(docs, spark.createDataFrame(labels, LABELS))).collect()}
    assert len(scores) == 1


CYRILLIC = ("по на то ре ли ка во ся ни да".split(), ["дурень", "болван", "мразюк"], " ")
HAN = (list("的一是在不了有和人这中大为上个国我以要他时来用们"), ["傻瓜蛋", "混账狗"], "")


@pytest.mark.parametrize("syllables, insults, space", [CYRILLIC, HAN])
def test_insults_in_other_scripts(spark, syllables, insults, space):
    rng, rows, labels = random.Random(6), [], []
    for k in range(500):
        words = ["".join(rng.choices(syllables, k=3)) for _ in range(rng.randrange(20, 60))]
        if bad := rng.random() < 0.3:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        end = ". " if space else "。"
        rows.append((k, "".join(w + rng.choice([space, space, space, end]) for w in words), "s", "l", "i"))
        labels.append((k, 1, int(bad)))
    docs, told = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    found = {r.doc_id: r for r in tox.score_documents(docs, tox.train(docs, told)).collect()}
    right = {kind: [found[k].predicted == bad for k, _, bad in labels if found[k].held_out and bad == kind] for kind in (0, 1)}
    assert min(sum(each) / len(each) for each in right.values()) > 0.95


def test_units_of_other_scripts():
    assert tox.units("Дурак, 12 élan—été".encode()) == {w.encode() for w in ("дурак", "élan", "été")}
    assert tox.units("д у р".encode()) == {w.encode() for w in ("д", "у", "р", "дур")}


def test_models_of_one_session_give_their_own_scores(spark):
    """Three models with equal tables, which one worker scores with one after the other."""
    docs = spark.createDataFrame([(1, "some text", *"sli")], DOCS).coalesce(1)
    scores = []
    for offset in (0.0, -6.9, 6.9):
        model = tox.Model(np.empty(0, np.float32), 0.0, (0.0, 0.0, 0.0, offset))
        scores.append(tox.score_documents(docs, model).first().score)
    assert np.allclose(scores, 1 / (1 + np.exp(-np.array([0.0, -6.9, 6.9]))))


def test_a_long_toxic_document_teaches_its_insults(spark):
    """Insults in a few of thousands of sentences, which a choice of two dozen sentences a document would mostly miss."""
    rng, syllables = random.Random(8), "the an re in er on at en ed or ti he st ou nd ar le ma so po".split()
    words = ["".join(rng.choices(syllables, k=3)) for _ in range(300)]
    prose = lambda n: ". ".join(" ".join(rng.choices(words, k=6)) for _ in range(n))
    toxic = [" zorgle. ".join(prose(1000) for _ in range(6)) + " quonker" for _ in range(12)]
    assert all(len(tox.sentences(text.encode())) > 4000 and any(b"quonker" in row for row in tox.sentences(text.encode())) for text in toxic)
    rows = [(k, prose(300), "s", "l", "i") for k in range(60)] + [(1000 + k, text, "s", "l", "i") for k, text in enumerate(toxic)]
    labels = [(k, 1, int(k >= 1000)) for k, *_ in rows]
    model = tox.train(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    assert tox.Scorer(model).decide([b"you zorgle", b"z o r g l e"])[:, 0].min() > 0


def test_occurrences_count_repeats():
    assert tox.occurrences(b"zorgle Zorgle, z o r g l e and zor-gle", {b"zorgle"}) == 4
    assert tox.occurrences("傻瓜蛋。好人。傻瓜蛋".encode(), {"傻瓜蛋".encode()}) == 2
