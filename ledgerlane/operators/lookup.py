"""Left lookups on columns that are often NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = 1024


def lookup(facts: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """Left join of ``facts`` to a table with unique keys, with the NULL keys spread out.

    NULL matches nothing, yet all NULL rows would hash to one task. They get a spread number as a second join key;
    rows with a key keep number 0, the only one the table has. Hot non-NULL keys are left to the adaptive skew join.
    """
    spread = F.when(
        F.col(key).isNull(), F.pmod(F.xxhash64(*[F.col(name) for name in facts.columns]), F.lit(_SPREAD))
    ).otherwise(F.lit(0))
    left = facts.withColumn("_spread", spread.cast("long"))
    right = table.withColumn("_only", F.lit(0).cast("long"))
    joined = left.join(right, (F.col(key) == F.col(table_key)) & (F.col("_spread") == F.col("_only")), "left")
    return joined.drop("_spread", "_only")
