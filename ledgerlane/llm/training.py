"""Bounded, reproducible samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.sources.publish import store


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: CRC-32 of its id as text, modulo ``folds``; NULL without an id."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, kept_back: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == kept_back, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, kept_back: int, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(label, text) of at most ``per_class`` documents a class, outside the fold kept back, and how many there are of each class.

    The documents are those with the smallest hashes of their ids. An id labelled more than once counts as 1 if any label is 1.
    """
    usable = labels.where(F.col(label).isin(0, 1) & (fold(F.col("doc_id"), folds) != kept_back))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(label).cast("int").alias("label"))
    usable = store(usable, "labelled")
    totals = {row.label: row["count"] for row in usable.groupBy("label").count().collect()}
    picked = None
    for value in sorted(totals):
        some = usable.where(F.col("label") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    if picked is None:
        return rows.limit(0).select(F.lit(0).alias("label"), "text"), totals
    # At most 2 * per_class rows: a bounded broadcast. A repeated id counts once.
    found = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).dropDuplicates(["doc_id"])
    return store(found.select("label", "text"), "sample"), totals
