"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm import decontamination, language_model, merkle, mixing, prefix_trie, quality_classifier, quality_rules, sharding, simhash, substring, token_files, toxicity, warc
from ledgerlane.llm.common import table
from ledgerlane.llm.training import held_out
from ledgerlane.sources.publish import scratch

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
WEIGHTS = (5.0, 2.0, 1.0)
SHARDS = 8
SEED = 0


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("text_hash")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = token_files.write_corpus(
        table(spark, sf_dir, "documents"), scratch(spark, "token-files"), public_tokenizers.path(TOKENIZER)
    )
    return token_files.read_corpus(spark, token_files.Corpus.load(corpus.uri))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.score_documents(table(spark, sf_dir, "documents"), trusted)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    printed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.shared_passages(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = scratch(spark, "warc")
    files = warc.write_archives(table(spark, sf_dir, "pages"), uri)
    return warc.read_archives(spark, uri, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score_documents(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_rows(mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS, seed=SEED))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS, SEED)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1).drop("text_hash")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv_id = F.col("conv_id")
    heads = F.crc32(conv_id.cast("string").cast("binary")) % 4
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns, conv_id - conv_id % 20, heads, most=3))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    manifest = merkle.build(table(spark, sf_dir, "documents"), tampered, {"text": lowered})
    return merkle.prove(manifest).drop("segments")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 7, 2)
    model = language_model.train(docs, scratch(spark, "language-model"), ~out)
    return language_model.score_documents(docs, model).withColumn("held_out", out)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_token_files,
        op3_quality_rules,
        op4_simhash,
        op5_substring,
        op6_warc,
        op7_quality_classifier,
        op8_mixing,
        op9_sharding,
        op10_decontamination,
        op11_prefix_trie,
        op12_merkle_manifest,
        op13_lm_scoring,
    )
}
