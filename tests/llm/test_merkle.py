from __future__ import annotations

import hashlib
import random
import string
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlane.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, path string, digest string, idx long, tree long"
COLUMNS = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        found.append([H(*found[-1][k : k + 16]) for k in range(0, len(found[-1]), 16)])
    return found


def siblings(tree, place):
    for level in tree[:-1]:
        start, digit = place - place % 16, place % 16
        run = level[start : start + 16]
        yield run[:digit], run[digit + 1 :]
        place //= 16


def plain(rows):
    """What the contract asks of (doc_id, text, lang, source, n_chars)."""
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    sources = {}
    for doc_id, text, lang, source, n_chars in rows:
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, plain_leaf(doc_id, source, lang, n_chars, text), doc_id, text, lang, n_chars))
    named = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in named:
        sources[source].sort(key=lambda r: r[:3])
        trees[source] = levels([r[2] for r in sources[source]])
    top = levels([trees[source][-1][0] for source in named])
    for rank, source in enumerate(named):
        for place, (_, _, leaf, doc_id, text, lang, n_chars) in enumerate(sources[source]):
            way = [*siblings(trees[source], place), *siblings(top, rank)]
            node = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                node = plain_leaf(doc_id, source, lang, n_chars, text and text.translate(lower))
            for left, right in way:
                node = H(*left, node, *right)
            root = top[-1][0]
            yield doc_id, leaf, trees[source][-1][0], root, H(*(d for pair in way for part in pair for d in part)), node, node == root


def found(spark, rows, schema=SCHEMA, parts=3):
    full = [(*row, "x", "y", "z", 1, 2) for row in rows]
    docs = spark.createDataFrame(full, schema).repartition(parts)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = merkle.build(docs, tampered, {"text": F.translate("text", string.ascii_uppercase, string.ascii_lowercase)})
    return [tuple(row[c] for c in COLUMNS) for row in merkle.prove(manifest).collect()], manifest


def test_equals_plain_python_on_many_sources(spark):
    draw = random.Random(3)
    rows = [(k, f"Text {k} É" * draw.randint(0, 9), draw.choice(["de", None]), f"s{draw.randint(0, 40)}", k % 7 or None) for k in range(900)]
    rows += [(5000 + k, "A hot source", "en", None, k) for k in range(300)]
    assert sorted(found(spark, rows)[0]) == sorted(plain(rows))


@pytest.mark.parametrize("count", [1, 2, 16, 17, 256, 257])
def test_one_source_of_each_depth(spark, count):
    rows = [(k * 3, f"T{k}", "en", "only", 1) for k in range(count)]
    assert sorted(found(spark, rows)[0]) == sorted(plain(rows))


def test_lone_leaves_are_subroots(spark):
    rows = [(k, f"T{k}", "en", f"s{k:02d}", 1) for k in range(18)] + [(100 + k, "x", "en", "s03", 1) for k in range(20)]
    got, _ = found(spark, rows)
    assert sorted(got) == sorted(plain(rows))
    assert sum(leaf == subroot for _, leaf, subroot, *_ in got) == 17


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None)] * 3 + [(7, "Ab", None, "s", 1), (7, "aB", None, "s", 1), (7, "Ab", None, "s", 1), (8, "", "", "", 0), (9, "Long É " * 300_000, "fr", "s", 2)]
    key = [repr(r) for r in plain(rows)]
    assert sorted(map(repr, found(spark, rows)[0])) == sorted(key)


def test_equal_subtrees_are_one_record(spark):
    rows = [(1, "same", "en", "s", 4)] * 512
    got, manifest = found(spark, rows)
    assert sorted(got) == sorted(plain(rows))
    assert manifest.records.count() == 3 and all(r.digest == H(r.children) for r in manifest.records.collect())


def test_some_requests_only(spark):
    rows = [(k, f"t{k}", "en", f"s{k % 3}", 1) for k in range(600)]
    _, manifest = found(spark, rows)
    some = merkle.prove(manifest, manifest.leaves.where("doc_id % 50 = 7"))
    want = sorted(row for row in plain(rows) if row[0] % 50 == 7)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in some.collect()) == want


def test_any_change_of_a_field_is_seen(spark):
    rows = [(k, f"t{k}", "en", "s", 1) for k in range(40)]
    docs = spark.createDataFrame([(*row, "x", "y", "z", 1, 2) for row in rows], SCHEMA)
    for name, value in (("lang", "eN"), ("n_chars", 2), ("source", "S")):
        manifest = merkle.build(docs, F.col("doc_id") == 11, {name: F.lit(value)})
        assert [r.doc_id for r in merkle.prove(manifest).where("NOT verified").collect()] == [11]


def test_empty_table(spark):
    assert found(spark, [])[0] == []


def test_plan_has_no_python_and_no_cross_join(spark):
    docs = spark.createDataFrame([(k, f"t{k}", "en", f"s{k % 3}", 1, "x", "y", "z", 1, 2) for k in range(100)], SCHEMA)
    plan = merkle.prove(merkle.build(docs))._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "InArrow", "EvalPython"))
