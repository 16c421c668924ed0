from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from ledgerlane.llm import decontamination as dec
from ledgerlane.llm.tokens import hashed

DOCS, ITEMS = "doc_id long, text string, lang string, item_id long, matched long", "item_id long, text string, doc_id long"


def prose(rng: random.Random, n: int) -> list[str]:
    return [f"{rng.choice('abcdé')}{rng.randrange(3000)}" for _ in range(n)]


def corpus(seed: int):
    rng = random.Random(seed)
    items = [(k, " ".join(prose(rng, rng.randrange(15, 60)))) for k in range(30)]
    docs, planted = [], set()
    for k in range(120):
        words = prose(rng, rng.randrange(30, 200))
        if k % 3 == 0:
            number = rng.randrange(30)
            leak = items[number][1].split()
            for at in range(4, len(leak), 11):
                if k % 2:
                    leak[at] = "other"
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in leak]
            planted.add((k, number))
        docs.append((k, " ".join(words), "en", 0, 0))
    return docs, items, planted


def test_finds_exactly_what_is_planted(spark):
    docs, items, planted = corpus(1)
    found = dec.overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == planted


def plain_overlaps(docs, items, least):
    """All diagonals of all pairs, a run by trying every start and end; no mask is asked."""
    out = set()
    for d, text in docs:
        a = dec.words_of(text.encode())
        for i, item in items:
            b = dec.words_of(item.encode())
            hit = False
            for shift in range(-len(b) + 1, len(a)):
                equal = np.array([a[x] == b[x - shift] for x in range(max(0, shift), min(len(a), shift + len(b)))])
                hit |= counts(equal, min(least, len(b)))
            if hit:
                out.add((d, i))
    return out


def counts(equal, least):
    """Whether some part has a best run of ``least`` words that no longer part betters."""
    value = np.concatenate([[0], np.cumsum(np.where(equal, 1, -dec.COST))])
    for s in range(len(equal)):
        for t in range(s + least, len(equal) + 1):
            inside = value[s : t + 1]
            # A run: no beginning and no end of it loses.
            if inside.min() == inside[0] and inside.max() == inside[-1] > inside[0]:
                return True
    return False


@pytest.mark.parametrize("words", range(12, 21))
def test_masks_hit_every_run_with_up_to_four_substitutions(words):
    rng = random.Random(words)
    for many in range(1, 5):
        places = list(itertools.combinations(range(words), many))
        for chosen in rng.sample(places, min(len(places), 400)):
            equal = np.ones(words, bool)
            equal[list(chosen)] = False
            if counts(equal, dec.LEAST):
                assert any(all(equal[s + k] for k, c in enumerate(mask) if c == "1") for mask in dec.MASKS for s in range(words - len(mask) + 1)), chosen


def test_a_longer_run_beside_a_better_one(spark):
    item = [f"q{k}" for k in range(60)]
    text = [*item[:11], *(f"x{k}" for k in range(20)), *item[31:38], "other", *item[39:46]]
    frame = spark.createDataFrame([(1, " ".join(text), "", 0, 0)], DOCS)
    row = dec.overlaps(frame, spark.createDataFrame([(2, " ".join(item), 0)], ITEMS)).first()
    assert (row.doc_start, row.doc_end, row.matched) == (31, 46, 14)


def test_short_items_and_scripts_without_spaces(spark):
    han = "一个国家的首都在哪里是什么样的城市呢"
    docs = [(1, "it is a four word item", "", 0, 0), (2, "nothing of it", "", 0, 0), (3, "前面的话" + han[:12] + "错" + han[13:] + "后面", "", 0, 0), (4, "首都", "", 0, 0), (5, "Four  WORD item.", "", 0, 0)]
    items = [(10, "four word item", 0), (11, han, 0), (12, "word", 0), (13, "首都", 0)]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert {(r.doc_id, r.item_id) for r in dec.overlaps(frame, bench).collect()} == {(3, 11)}
    everything = dec.overlaps(frame, bench, shortest=1).collect()
    assert {(r.doc_id, r.item_id) for r in everything} == {(3, 11), (1, 10), (5, 10), (1, 12), (5, 12), (3, 13), (4, 13)}
    assert {(r.doc_start, r.doc_end) for r in everything if (r.doc_id, r.item_id) == (1, 10)} == {(3, 6)}
    assert sorted(r.item_id for r in dec.short_items(bench).collect()) == [10, 12, 13]
    assert sorted(r.doc_id for r in dec.drop_contaminated(frame, bench).collect()) == [1, 2, 4, 5]
    assert sorted(r.doc_id for r in dec.drop_contaminated(frame, bench, shortest=1).collect()) == [2]


def test_equals_brute_force_over_all_diagonals(spark):
    rng = random.Random(7)
    items = [(k, " ".join(f"w{rng.randrange(12)}" for _ in range(rng.randrange(13, 20)))) for k in range(6)]
    docs = []
    for k in range(25):
        words = [f"w{rng.randrange(12)}" for _ in range(rng.randrange(10, 40))]
        leak = rng.choice(items)[1].split()[rng.randrange(4) :]
        leak[rng.randrange(len(leak))] = "w99"
        docs.append((k, " ".join(words + leak)))
    found = dec.overlaps(spark.createDataFrame([(i, t, "", 0, 0) for i, t in docs], DOCS), spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == plain_overlaps(docs, items, dec.LEAST)


def test_places_and_matches(spark):
    item = " ".join(f"q{k}" for k in range(20))
    text = "before it " + item.replace("q7 ", "zzz ") + " after"
    row = dec.overlaps(spark.createDataFrame([(5, text, "", 0, 0)], DOCS), spark.createDataFrame([(9, item, 0)], ITEMS)).first()
    assert (row.doc_id, row.item_id, row.n_items, row.doc_start, row.doc_end, row.item_start, row.matched) == (5, 9, 1, 2, 22, 0, 19)


def test_blocks_cover_the_whole_benchmark(spark, monkeypatch):
    docs, items, planted = corpus(2)
    monkeypatch.setattr(dec, "BLOCK_WORDS", 200)
    found = dec.overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == planted


def test_odd_rows(spark):
    long = " ".join(f"t{k}" for k in range(30))
    docs = [(1, None, None, None, None), (2, "", "", 0, 0), (None, long, "", 0, 0), (3, long, "", 0, 0), (3, long, "", 0, 0), (4, "six little words are in here", "", 0, 0), (5, "a b c", "", 0, 0)]
    items = [(1, long, 0), (None, long, 0), (7, long.upper(), 0), (8, None, 0), (9, "", 0), (10, "six little words are in here", 0), (11, "a b c", 0)]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = sorted((str(r.doc_id), r.item_id, r.n_items) for r in dec.overlaps(frame, bench).collect())
    assert found == [("3", 1, 3), ("3", 1, 3), ("4", 10, 1), ("None", 1, 3)]
    kept = dec.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5"]
    assert dec.overlaps(frame.limit(0), bench).collect() == []
    assert dec.overlaps(frame, bench.limit(0)).collect() == []
    assert dec.drop_contaminated(frame, bench.limit(0)).count() == len(docs)


def test_very_long_text(spark):
    words = [f"v{k % 5000}x{k}" for k in range(60_000)]
    item = " ".join(words[40_000:40_030])
    row = dec.overlaps(spark.createDataFrame([(1, " ".join(words), "", 0, 0)], DOCS), spark.createDataFrame([(2, item, 0)], ITEMS)).collect()
    assert [(r.doc_start, r.doc_end, r.matched) for r in row] == [(40_000, 40_030, 30)]


@pytest.mark.parametrize("seed", range(5))
def test_best_run_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    equal = rng.random(40) < 0.75
    start, end, matched = dec.best_run(equal)
    value = lambda a, b: int(np.where(equal[a:b], 1, -dec.COST).sum())
    assert matched == equal[start:end].sum()
    assert value(start, end) == max(value(a, b) for a in range(41) for b in range(a, 41))


def test_windows_stay_in_their_text():
    words = hashed([[b"a", b"b"], [], [b"c", b"d", b"e"]])
    assert words.windows(2).tolist() == [0, 2, 3] and words.windows(4).tolist() == []
