"""Tables stored in buckets of a key, so that joins on it need no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerlane.sources.publish import scratch
from ledgerlane.sources.tables import Tables


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store ``df`` as the table ``name`` at ``path``, in ``buckets`` buckets of ``key`` that are sorted by it.

    The rows are dealt out by the key's hash first, so a bucket is one file and not one per task. Tables that are to be joined need the same number of
    buckets; choose it by the size of the largest so that a bucket fits a task. A key that holds a large share of the rows makes a large
    bucket, which no join splits afterwards: such tables are better left unbucketed, where the adaptive skew join splits them.
    """
    rows = df.repartition(buckets, key).sortWithinPartitions(key)
    rows.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


class Bucketed(Mapping):
    """A table mapping that reads the tables stored in buckets, and the others where they were."""

    def __init__(self, spark: SparkSession, tables: Tables, names: Mapping[str, str]) -> None:
        self.spark, self.tables, self.names = spark, tables, dict(names)

    def __getitem__(self, table: str) -> DataFrame:
        return self.spark.table(self.names[table]) if table in self.names else self.tables[table]

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


def bucketed(spark: SparkSession, tables: Tables, keys: Mapping[str, str], buckets: int | None = None) -> Bucketed:
    """Copies of the named tables in buckets of their key, in scratch folders; as many buckets as shuffle partitions unless said."""
    count, names = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), {}
    for table, key in keys.items():
        names[table] = f"{table}_{uuid.uuid4().hex}"
        write_bucketed(tables[table], names[table], f"{scratch(spark, 'bucketed')}/rows", key, count)
    return Bucketed(spark, tables, names)


@contextmanager
def bucketed_copies(spark: SparkSession, tables: Tables, keys: Mapping[str, str], buckets: int | None = None) -> Iterator[Bucketed]:
    """As :func:`bucketed`, for the length of a block; the names leave the catalogue at its end."""
    stored = bucketed(spark, tables, keys, buckets)
    try:
        yield stored
    finally:
        for name in stored.names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
