"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and, but for the last, returns the columns of
``documents``. What NULLs, repeated rows and other odd input give is said in the operators' modules; rows with NULL in any column pass
through all stages that have no reason to drop them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlane.llm import decontamination, mixing, simhash, token_files, toxicity
from ledgerlane.llm.common import ship, table
from ledgerlane.llm.queries import SEED, TOKENIZER, WEIGHTS
from ledgerlane.sources.publish import scratch, store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine doesn't reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    ship(spark)
    return simhash.keep_one(docs, shingle=3, radius=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target says."""
    return mixing.apply_mix(docs, mixing.mix(docs, WEIGHTS, seed=SEED), seed=SEED)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; per document its place in them."""
    ship(spark)
    corpus = token_files.write_corpus(docs, scratch(spark, "token-files"), public_tokenizers.path(TOKENIZER))
    return token_files.read_corpus(spark, token_files.Corpus.load(corpus.uri))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: SQL has no fitted machine, no XXH64 and no tokenizer; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
