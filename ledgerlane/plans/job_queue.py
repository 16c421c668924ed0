"""Queue rows for closures that were never processed, over all tenants."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.sources.tables import TENANT

# Fixed values of a queue row, and the first closure day that is looked at.
JOB_TYPE = "PosRegisterClosure"
JOB_PRIORITY = 1
JOB_STATUS = "NUEVO"
SINCE = date(2022, 12, 1)


def closure_jobs(closures: DataFrame, since: date = SINCE, tenants: Iterable[str] | None = None) -> DataFrame:
    """One queue row per closure that is neither done nor failed; a NULL done flag drops the closure.

    A filter over the tenant-partitioned table: no shuffle. ``values_text`` is the row as SQL VALUES text, NULL if a
    part of it is.
    """
    waiting = closures.where(
        ~F.col("register_closure_done")
        & F.col("register_closure_exception").isNull()
        & (F.col("register_closure_date") >= F.lit(since))
    )
    if tenants is not None:
        waiting = waiting.where(F.col(TENANT).isin(list(tenants)))
    values = F.concat(
        F.lit("  ("),
        F.col("company_key").cast("string"),
        F.lit(",'"),
        F.col("id"),
        F.lit(f"','{JOB_TYPE}',{JOB_PRIORITY},'{JOB_STATUS}'),"),
    )
    return waiting.select(
        TENANT,
        "company_key",
        F.col("id").alias("entity_id"),
        F.lit(JOB_TYPE).alias("job_master_type"),
        F.lit(JOB_PRIORITY).alias("job_master_priority"),
        F.lit(JOB_STATUS).alias("job_master_status"),
        values.alias("values_text"),
    )
