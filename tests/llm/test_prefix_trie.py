from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlane.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos string, x string, words string, slot string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def ordered(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv_id: [turn[2:] for turn in sorted(turns, key=lambda t: t[:2])] for conv_id, turns in convs.items()}


def given_heads(convs):
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
    return {c: convs.get(c - c % 20, [])[: heads[c]] + turns[heads[c] :] for c, turns in convs.items()}


def plain(convs):
    members, children = {}, {}
    for conv_id, turns in convs.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv_id)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        words = len(node[-1][1].encode().split()) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in below)
    for node, those in members.items():
        ends = ",".join(str(c) for c in sorted(those) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        yield min(those), len(node), parent, len(those), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*row, "p", "x", "w", "s") for row in rows], SCHEMA).repartition(parts)


def collected(df):
    return sorted((tuple(row[c] for c in COLUMNS) for row in df.collect()), key=repr)


def of(convs):
    return sorted(plain(convs), key=repr)


@pytest.fixture
def many_tasks(spark):
    """Every sorted table over several tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def drawn(seed, convs=150, longest=7):
    draw = random.Random(seed)
    return [(c - 30, t * 10, draw.choice(["user", "bot"]), draw.choice(["a", "b c", "a"])) for c in range(convs) for t in range(draw.randint(1, longest))]


@pytest.mark.parametrize("widest", [64, 1 << 20])
def test_equals_plain_python_at_any_width(spark, many_tasks, widest):
    rows = drawn(1)
    turns = prefix_trie.ordered_turns(frame(spark, rows))
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
    assert collected(prefix_trie.trie(turns.join(lengths, "conv_id"), lengths, widest)) == of(ordered(rows))


def test_heads_of_other_conversations(spark, many_tasks):
    rows = [row for row in drawn(2, 200) if row[0] >= 0 and row[0] != 40]  # an absent donor
    conv_id, heads = F.col("conv_id"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    turns = prefix_trie.ordered_turns(frame(spark, rows))
    found = prefix_trie.trie(*prefix_trie.rebuilt(turns, conv_id - conv_id % 20, heads, most=3))
    assert collected(found) == of(given_heads(ordered(rows)))


def test_one_conversation_holds_most_turns_and_another_repeats_it(spark, many_tasks):
    hot = [(c, t, "user", f"turn {t % 5} of it") for c in (3, 9) for t in range(700)]
    rows = hot + [(c, t, "user", f"turn {t}") for c in (1, 5, 12) for t in range(3)]
    assert collected(prefix_trie.prefix_trie(frame(spark, rows))) == of(ordered(rows))


def test_thousands_of_copies(spark, many_tasks):
    rows = [(c, t, "user", ["hello there", "more", f"end {c % 3}"][t]) for c in range(6000) for t in range(3)]
    found = collected(prefix_trie.prefix_trie(frame(spark, rows)))
    assert found == of(ordered(rows)) and len(found) == 6


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(1, None, None, None), (1, 1, "", ""), (1, 1, "", ""), (2, None, "", None), (2, 1, None, ""), (2, 1, "", ""), (4, 1, "a", "b"), (5, 1, "", "ab")]
    rows += [(7, 1, "user", "long É " * 300_000), (8, 1, "user", "long É " * 300_000), (None, 1, "user", "nobody's")]
    assert collected(prefix_trie.prefix_trie(frame(spark, rows))) == of(ordered(rows))


def test_role_and_text_do_not_run_into_each_other(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "1:a", "b")]
    assert len(collected(prefix_trie.prefix_trie(frame(spark, rows)))) == 4


def test_conversations_without_turns(spark):
    """Ids whose donor is absent and whose own turns all go."""
    rows = [(c, 0, "user", "only") for c in range(1, 20)]
    conv_id, heads = F.col("conv_id"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    found = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.ordered_turns(frame(spark, rows)), conv_id - conv_id % 20, heads, most=3))
    assert collected(found) == of(given_heads(ordered(rows)))


def test_empty_table(spark):
    assert collected(prefix_trie.prefix_trie(frame(spark, []))) == []


def test_proven_tails_are_not_grouped(spark):
    rows = [(c, t, "user", f"{c} says {t}") for c in range(50) for t in range(6)]
    turns = prefix_trie.ordered_turns(frame(spark, rows)).withColumn("length", F.lit(6).cast("long"))
    assert prefix_trie.screened(prefix_trie.prefixes(turns)).where("single").count() > 280
