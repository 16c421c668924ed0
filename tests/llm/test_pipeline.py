"""Every stage over the smallest test data against plain Python, each on what the stage before it kept."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerlane.llm import toxicity
from test_decontamination import dec
from test_mixing import plain_mix
from test_simhash import plain_components
from test_token_files import expected as plain_tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF).collect()
        out.append(([tuple(r) for r in docs.collect()], docs.columns, [tuple(r) for r in kept]))
        if stage is not corpus_pipeline.STAGES[-1][1]:
            docs = spark.createDataFrame(kept, docs.schema)
    return out


def test_toxicity(spark, stages):
    before, _, after = stages[0]
    docs = spark.createDataFrame(before, spark.read.parquet(f"{SF}/documents.parquet").schema)
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rejected = [row for row in before if model.score(toxicity.Scorer(model).decide([row[1].encode()]))[0] >= 0.7]
    assert Counter(after) == Counter(before) - Counter(rejected)


def test_simhash(stages):
    before, _, after = stages[1]
    least = {component for _, _, component in plain_components([(r[0], r[1]) for r in before])}
    assert len(after) < len(before) and Counter(after) == Counter(r for r in before if r[0] in least)


def test_decontamination(spark, stages):
    before, _, after = stages[2]
    items = [dec.words_of(r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        words = dec.words_of(text.encode())
        joined = b" " + b" ".join(words) + b" "
        return any(b" " + b" ".join(item[k : k + dec.LEAST]) + b" " in joined for item in items for k in range(max(1, len(item) - dec.LEAST + 1)))

    assert Counter(after) == Counter(r for r in before if not leaks(r[1]))


def test_mixing(stages):
    before, columns, after = stages[3]
    at = columns.index("source")
    taken = {i: (size, amount) for i, size, _, _, amount in plain_mix([(r[0], r[1], r[at]) for r in before])}
    copies = Counter(after)
    assert all(size == 0 or copies[r] == taken[r[0]][1] // size for r in before for size in [taken[r[0]][0]])


def test_token_files(stages):
    before, _, after = stages[4]
    rows = sorted((r[0], r[1]) for r in before)
    assert sorted(after, key=lambda r: r[1]) == plain_tokens(rows)
    assert all(isinstance(zlib.crc32(np.array([r[0]]).tobytes()), int) for r in after)


def test_run_applies_all_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(stages[-1][2])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with NULLs in every column, repeated rows, an empty and a very long text, and columns with the operators' own names."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(*row, "t", 0.5, 7, "k") for row in given.limit(60).collect()]
    kinds = [name for name, _ in given.dtypes]
    base = dict.fromkeys(kinds)
    more = [
        {**base},
        {**base, "doc_id": 9001},
        {**base, "text": "a text without an id"},
        {**base, "doc_id": 9002, "text": "", "source": "src0", "lang": "en", "n_chars": 0},
        {**base, "doc_id": 9003, "text": " ".join(f"word{k % 700}x{k}" for k in range(60_000)), "source": "src0", "n_chars": 1},
        {**base, "doc_id": 9004, "text": "twice the same row", "source": "src1"},
        {**base, "doc_id": 9004, "text": "twice the same row", "source": "src1"},
        {**base, "doc_id": 9004, "text": "the id again, another text", "source": "src1"},
    ]
    rows += [(*(row[name] for name in kinds), None, None, None, None) for row in more]
    schema = ", ".join(f"{name} {kind}" for name, kind in given.dtypes)
    return spark.createDataFrame(rows, f"{schema}, text_hash string, score double, item_id long, _text_hash string")


def test_stages_handle_odd_rows(spark, odd):
    docs, before = odd, [tuple(row) for row in odd.collect()]
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        if name == "token_files":
            found = kept.collect()
            assert Counter(row.doc_id for row in found) == Counter(row[0] for row in before)
            assert sum(row.n_tokens for row in found) == max(row.start + row.n_tokens for row in found)
            continue
        assert kept.columns == docs.columns
        after = [tuple(row) for row in kept.collect()]
        if name != "mixing":
            assert not Counter(after) - Counter(before)  # nothing new, nothing changed
        ids = {row[0] for row in after}
        assert {9003, 9004} <= ids  # clean documents stay
        if name == "simhash":  # of rows without words one stays, and one of each repeated row
            assert sum(not (row[1] or "").split() for row in after) == 1
            assert max(Counter(after).values()) == 1
        docs, before = spark.createDataFrame(after, docs.schema), after
