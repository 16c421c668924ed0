"""Readers for the tenant-partitioned tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ledgerlane.sources.reconcile import reading_plan, reconciled
from ledgerlane.sources.schemas import TABLES, TENANT, table_schema

Tables = Mapping[str, DataFrame]


def read_tables(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = tuple(TABLES),
    tenants: Iterable[str] | None = None,
    collation: str | None = None,
    schemas: Mapping[str, StructType] | None = None,
    reconcile: bool = False,
) -> dict[str, DataFrame]:
    """Read ``root/<table>`` Parquet folders, each optionally partitioned by ``tenant_db``.

    A table has the columns of all its tenants, and the declared columns that none of them has, as NULL. Merging the tenants' columns
    reads the footer of every file; over very many files keep the schemas of one such read and pass them as ``schemas``.
    ``tenants`` prunes to those partitions. ``collation`` (for example ``UNICODE_CI_AI``) makes text comparisons
    ignore case and accents as the source database did; it is off by default because collated text
    cannot be pushed into the Parquet scan.

    Tenants that store a column under different types cannot be merged, and Spark raises. With ``reconcile`` every schema is read on its own and
    each column gets its declared or the least common type; ``sources.reconcile`` tells which values that cannot hold.
    """
    wanted = None if tenants is None else list(tenants)
    frames = {}
    for name in names:
        if reconcile:
            plan = reading_plan(spark, f"{root}/{name}", table_schema(name) if name in TABLES else None, wanted)
            frame = reconciled(spark, plan).frame
            frames[name] = frame if collation is None else with_collation(frame, collation)
            continue
        known = (schemas or {}).get(name)
        reader = spark.read.option("mergeSchema", "true") if known is None else spark.read.schema(known)
        frame = _with_declared(reader.parquet(f"{root}/{name}"), name)
        if wanted is not None:
            frame = frame.where(F.col(TENANT).isin(wanted))
        frames[name] = frame if collation is None else with_collation(frame, collation)
    return frames


def _with_declared(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` with the columns the jobs expect of the table, NULL where no tenant has them."""
    if name not in TABLES:
        return frame
    present = {column.lower() for column in frame.columns}
    missing = [field for field in table_schema(name).fields if field.name.lower() not in present]
    return frame.withColumns({field.name: F.lit(None).cast(field.dataType) for field in missing}) if missing else frame


def union_tenants(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One table from one frame per tenant; a column a tenant lacks becomes NULL there."""
    tagged = [frame.withColumn(TENANT, F.lit(tenant)) for tenant, frame in frames.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged)


def with_collation(df: DataFrame, collation: str) -> DataFrame:
    """Every text column of ``df`` under ``collation``."""
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, StringType)]
    return df.withColumns({name: F.collate(F.col(name), collation) for name in texts})
