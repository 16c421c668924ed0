"""Text compared without case and accents, with filters that still reach the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The comparison of the source database: case and accents don't count.
BLIND = "UNICODE_CI_AI"

#: Spellings of one column that become a literal list.
SPELLINGS = 1000


def spellings(df: DataFrame, column: str, values: Sequence[str], collation: str = BLIND) -> list[str] | None:
    """The stored spellings of ``values`` in a column; None if they are more than :data:`SPELLINGS`.

    Reads the one column, reduced to distinct values before the shuffle and in the tasks. At most ``SPELLINGS`` + 1 of them come back.
    """
    same = F.collate(F.col(column), collation).isin(*[F.collate(F.lit(value), collation) for value in values])
    found = df.select(column).distinct().where(same).limit(SPELLINGS + 1).collect()
    return None if len(found) > SPELLINGS else sorted(row[0] for row in found)


def collated(df: DataFrame, columns: Sequence[str], wanted: Mapping[str, Sequence[str]] | None = None, collation: str = BLIND) -> DataFrame:
    """``df`` with ``columns`` under a collation, cut down to rows whose columns hold one of the ``wanted`` values, however spelled.

    Collated text can't be compared in the Parquet scan. So the spellings that occur are looked up first, and become a plain list of values that is
    compared byte by byte and reaches the scan; with too many spellings the collated test alone remains. Either way the rows are the same.
    """
    for column, values in (wanted or {}).items():
        known = spellings(df, column, values, collation)
        df = df.where(F.col(column).isin(known) if known is not None else F.collate(F.col(column), collation).isin(list(values)))
    return df.withColumns({column: F.collate(F.col(column), collation) for column in columns})


def join_collated(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", collation: str = BLIND) -> DataFrame:
    """Equi-join on text keys under a collation; the result has the left spellings of the keys.

    The keys are mapped to their collation keys for the shuffle, so equal keys meet in one task and skewed ones can be split.
    """
    other = right.select(*[F.collate(F.col(key), collation).alias(f"_{key}") for key in keys], *[name for name in right.columns if name not in keys])
    condition = reduce(Column.__and__, [F.collate(left[key], collation) == F.col(f"_{key}") for key in keys])
    return left.join(other, condition, how).drop(*[f"_{key}" for key in keys])


def sum_collated(df: DataFrame, keys: Sequence[str], sums: Sequence[str], others: Sequence[str] = (), collation: str = BLIND) -> DataFrame:
    """Sums per group of keys that are equal under a collation, and of ``others`` compared as they are.

    Each group shows the first of its spellings in byte order; NULL is a group. Rows are summed by their exact spelling first, in hash aggregation, so the
    sort that grouping by collated text takes sees a row per spelling and not every row.
    """
    exact = df.groupBy(*keys, *others).agg(*[F.sum(name).alias(name) for name in sums])
    blind = [F.collate(F.col(key), collation).alias(f"_{key}") for key in keys]
    shown = [F.min(key).alias(key) for key in keys] + [F.sum(name).alias(name) for name in sums]
    return exact.groupBy(*blind, *others).agg(*shown).drop(*[f"_{key}" for key in keys])
