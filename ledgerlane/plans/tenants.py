"""Questions over all tenants: records by id, and columns or payload keys that some tenants lack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.payload import allow_repeated_keys, elements, entry
from ledgerlane.sources.tables import TENANT


def find_by_id(df: DataFrame, ids: Sequence[str] | DataFrame, id_column: str = "id") -> DataFrame:
    """The records with the given ids in every tenant.

    A list of ids becomes a filter that reaches the scan; a frame of ids becomes a semi join.
    """
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(id_column)), id_column, "left_semi").select(*df.columns)
    return df.where(F.col(id_column).isin(list(ids)))


def column_drift(
    df: DataFrame, tenant_col: str = TENANT, present_in: str | None = None, missing_in: str | None = None
) -> DataFrame:
    """Columns that hold values for one tenant and only NULL for another.

    With ``present_in`` and ``missing_in`` only these two tenants are scanned and the result is their difference, one way.
    Without them every tenant is compared with all others together: one row per tenant and column it lacks.
    """
    frame = _only(df, tenant_col, present_in, missing_in)
    names = [name for name in frame.columns if name != tenant_col]
    counts = frame.groupBy(F.col(tenant_col).alias("tenant")).agg(*[F.count(name).alias(name) for name in names])
    used = counts.unpivot("tenant", names, "name", "filled").where(F.col("filled") > 0)
    return _lacking(used, frame, tenant_col, present_in, missing_in)


def payload_key_drift(
    df: DataFrame,
    json_col: str,
    tenant_col: str = TENANT,
    present_in: str | None = None,
    missing_in: str | None = None,
) -> DataFrame:
    """Keys of the objects in a JSON array column that one tenant writes and another never does.

    The parameters work as in :func:`column_drift`. Keys are reduced to distinct (tenant, key) pairs before the shuffle.
    """
    frame = allow_repeated_keys(_only(df, tenant_col, present_in, missing_in))
    keyed = frame.select(F.col(tenant_col).alias("tenant"), F.explode(elements(F.col(json_col))).alias("element"))
    names = F.map_keys(entry(F.col("element")))
    used = keyed.select("tenant", F.explode(names).alias("name")).distinct()
    return _lacking(used, frame, tenant_col, present_in, missing_in)


def _only(df: DataFrame, tenant_col: str, present_in: str | None, missing_in: str | None) -> DataFrame:
    if (present_in is None) != (missing_in is None):
        raise ValueError("name both tenants or neither")
    return df if present_in is None else df.where(F.col(tenant_col).isin(present_in, missing_in))


def _lacking(
    used: DataFrame, frame: DataFrame, tenant_col: str, present_in: str | None, missing_in: str | None
) -> DataFrame:
    """From the names each tenant uses, the tenants that do not use them. Lists here have one entry per tenant."""
    per_name = used.groupBy("name").agg(F.collect_set("tenant").alias("present"))
    if present_in is not None:
        return per_name.where(
            F.array_contains("present", present_in) & ~F.array_contains("present", missing_in)
        ).select(F.lit(present_in).alias("present_in"), F.lit(missing_in).alias("missing_in"), "name")
    tenants = frame.agg(F.collect_set(tenant_col)).scalar()
    return per_name.select(
        F.explode(F.array_except(tenants, "present")).alias("missing_in"),
        "name",
        F.size("present").cast("long").alias("present_tenants"),
    )
