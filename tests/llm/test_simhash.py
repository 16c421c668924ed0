from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from ledgerlane.llm import simhash
from ledgerlane.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string"


def plain_fingerprint(text: str | None, size: int = 3) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(edges, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_edges(values, radius):
    values = sorted(values)
    return [(a, b) for k, a in enumerate(values) for b in values[k + 1 :] if (a ^ b).bit_count() <= radius]


def plain_components(rows):
    prints = {k: plain_fingerprint(text) for k, (_, text) in enumerate(rows)}
    root = components(near_edges(set(prints.values()), 3), set(prints.values()))
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        r = root[prints[k]]
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    return [(doc_id, f"{prints[k]:016x}", least[root[prints[k]]]) for k, (doc_id, _) in enumerate(rows)]


def computed(frame):
    return [(r.doc_id, f"{r.fingerprint % (1 << 64):016x}", r.component_id) for r in simhash.near_duplicates(frame).collect()]


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('ABCdefÉ')}w{k}" for k in range(400)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.5:
            words = rng.choice(out).split(" ")
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.randrange(1, 200))
        out.append(" ".join(words))
    return out


def test_components_equal_brute_force(spark):
    rows = list(enumerate(texts(1, 250)))
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA)
    assert sorted(computed(frame)) == sorted(plain_components(rows))


@pytest.mark.parametrize("shard", [16, 64])
def test_large_shards_are_split_without_losing_links(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    rng, values = random.Random(3), set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        values |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(40)}
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    edges = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(frame, 3).collect()]
    assert all(a in values and b in values for a, b in edges)
    assert components(edges, values) == components(near_edges(values, 3), values)


def test_tree_takes_what_is_near_and_forest_stays_small():
    rng = random.Random(5)
    values = sorted({rng.getrandbits(12) for _ in range(300)})
    tree, left = simhash.BKTree(values), set(values)
    for value in rng.sample(values, 40):
        expected = {v for v in left if (v ^ value).bit_count() <= 2}
        assert set(tree.take(value, 2)) == expected
        left -= expected
    links = simhash.forest(values, 1)
    assert len(links) < len(values)
    assert components(links, values) == components(near_edges(values, 1), values)


def test_connected_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 130)] + [(200, 200), (-5, 300), (300, 301), (-5, 301)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for edge in edges for n in edge}
    expected = components(edges, nodes)
    assert found == {n: r for n, r in expected.items() if n != r}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


ODD = [(1, None, "a"), (2, "", None), (None, "  \n ", "b"), (3, "one two", None), (4, "ONE\ttwo", "c"), (4, "ONE\ttwo", "c"), (5, "x" * 70_000, "d")]


def test_odd_rows(spark):
    frame = spark.createDataFrame(ODD, SCHEMA)
    assert sorted(map(str, computed(frame))) == sorted(map(str, plain_components([(i, t) for i, t, _ in ODD])))
    assert computed(frame.limit(0)) == []


def test_very_long_text(spark):
    text = " ".join(f"w{k % 9973}" for k in range(150_000))
    frame = spark.createDataFrame([(1, text, "a")], SCHEMA)
    assert [row[1] for row in computed(frame)] == [f"{plain_fingerprint(text):016x}"]


def test_one_row_of_each_component_stays(spark):
    columns = "doc_id long, text string, fingerprint string, root string, _text_hash string, component_id string"
    rows = [(i, t, "f", "r", "h", None) for i, t, _ in ODD] + [(None, "alone in the world", "f", "r", None, "c")]
    kept = simhash.keep_one(spark.createDataFrame(rows, columns))
    assert kept.columns == ["doc_id", "text", "fingerprint", "root", "_text_hash", "component_id"]
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in kept.collect() if r.text is not None) == [
        (-1, "alone in the world"),
        (3, "one two"),
        (5, "x" * 70_000),
    ]
    assert [r.doc_id for r in kept.collect() if r.text is None] == [1]
    repeated = spark.createDataFrame([(7, "same", *"frhc")] * 5, columns)
    assert [r.doc_id for r in simhash.keep_one(repeated).collect()] == [7]
    assert simhash.keep_one(repeated.limit(0)).collect() == []
