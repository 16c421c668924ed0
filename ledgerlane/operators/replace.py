"""Keyed replace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def replace_into(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with every row whose key occurs in ``source`` replaced by the source row, and new keys added.

    Keys that vanished from the source stay. A key with a NULL part never matches, as in a unique index. Columns that only one
    side has stay and are NULL in the other's rows. ``source`` has one row per key, so neither side of the join can be skewed.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)
