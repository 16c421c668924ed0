"""Mixing sources to target weights.

Every row has a key, a hash of its id and text. Within each source the rows are range-sorted by key, sizes are summed in
that order (a prefix sum within each key range plus the sums of the ranges before it), and the source's budget cuts the
order: whole epochs first, then the rows up to the cut. The row that the cut goes through is taken if that comes nearer to the
budget, so no text is cut in two. A source's cut is one key, so decisions are applied to texts without moving them.

NULL text has size 0. NULL is a source of its own, last in order. Rows equal in id and text share a key and are taken together.
Rows of size 0 are taken as often as their place in the order says. A table without words has targets of 0 and takes each
row 0 times. An empty table gives no rows. Other columns pass through ``apply_mix`` untouched, under any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.common import fresh, word_count
from ledgerlane.sources.publish import store

#: Rows of a key range, on average; a range is what one task sorts at once.
ROWS_PER_RANGE = 4096
#: Keys are 60-bit numbers: 15 hex digits of an MD5.
KEY_DIGITS = 15


@dataclass(frozen=True)
class Mix:
    """``sizes``: source, doc_id, size, key per row. ``cuts``: per source, its figures, full epochs and the last taken key."""

    sizes: DataFrame
    cuts: DataFrame


def row_key(doc_id: Column, text: Column, seed: int) -> Column:
    """The hash-random key of a row as a number below 16**15."""
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, KEY_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: rows, source_size and target.

    Weights go round over the sources in order of code points, NULL last. A target is ``weight`` times a common level, at most
    ``most`` times the source's size; sources reach that cap in the order of cap over weight, which fixes the level. The windows
    run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    ranked = sources.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    levelled = capped.withColumn("_level", level).withColumn("_free", F.col("_level") * F.col("_weight") < F.col("_cap"))
    first = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("_weight"), F.col("_rank"), F.col("_level")))).over(everything)
    common = levelled.withColumn("_first", first)
    target = F.when(F.col("_first").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_first._level") * F.col("_weight")))
    return common.select("source", "rows", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[float], share: float = 1.5, most: float = 2.0, seed: int = 0) -> Mix:
    """Plan the mix of ``docs`` (doc_id, text, source). Only ids, sources, sizes and keys are moved."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select(
        F.col("source").cast("string").alias("source"), doc_id.alias("doc_id"), word_count(text).alias("size"), row_key(doc_id, text, seed).alias("key")
    )
    sizes = store(rows, "mix-sizes")
    targets = store(source_targets(sizes, weights, share, most), "mix-targets")
    # Whole epochs and what is left for the cut; exact, as sizes are integers.
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = targets.withColumn("epochs", whole).withColumn("_left", F.col("target") - F.col("epochs") * F.col("source_size"))
    key_range = F.floor(F.col("key") / (float(16**KEY_DIGITS) / F.greatest(F.lit(1), F.ceil(F.col("rows") / ROWS_PER_RANGE)))).cast("long")
    spread = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).select(sizes["source"], "key", "size", "_left", key_range.alias("_range"))
    # Rows of one key (equal id and text) count as one.
    keyed = spread.groupBy("source", "_range", "key", "_left").agg(F.sum("size").alias("size"))
    within = Window.partitionBy("source", "_range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    ranges = keyed.groupBy("source", "_range").agg(F.sum("size").alias("_range_size"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select(F.col("source").alias("_source"), F.col("_range").alias("_base_range"), F.coalesce(F.sum("_range_size").over(earlier), F.lit(0)).alias("_base"))
    placed = keyed.withColumn("_local", F.sum("size").over(within))
    placed = placed.join(bases, placed["source"].eqNullSafe(bases["_source"]) & (placed["_range"] == bases["_base_range"]))
    end = F.col("_base") + F.col("_local")
    nearer = end - F.col("_left") < F.col("_left") - (end - F.col("size"))
    inside = (F.col("_left") > 0) & ((end <= F.col("_left")) | nearer)
    cut = placed.where(inside).groupBy(F.col("source").alias("_source")).agg(F.max("key").alias("last_key"))
    cuts = targets.join(cut, targets["source"].eqNullSafe(cut["_source"]), "left")
    return Mix(sizes, store(cuts.select("source", "source_size", "target", "epochs", "last_key"), "mix-cuts"))


def copies(epochs: Column, last_key: Column, key: Column) -> Column:
    """How often the mix takes a row."""
    return (epochs + F.when(key <= last_key, 1).otherwise(0)).cast("int")


def taken_rows(planned: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    sizes, cuts = planned.sizes, planned.cuts
    joined = sizes.join(cuts, sizes["source"].eqNullSafe(cuts["source"]))
    times = copies(F.col("epochs"), F.col("last_key"), F.col("key"))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def apply_mix(docs: DataFrame, planned: Mix, seed: int = 0) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    cut, copy = fresh(docs, "_cut"), fresh(docs, "_copy")
    cuts = planned.cuts.select(F.struct("source", "epochs", "last_key").alias(cut))
    key = row_key(docs["doc_id"].cast("long"), docs["text"].cast("string"), seed)
    joined = docs.join(cuts, docs["source"].cast("string").eqNullSafe(F.col(f"{cut}.source")))
    times = copies(F.col(f"{cut}.epochs"), F.col(f"{cut}.last_key"), key)
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times))).drop(cut, copy)
