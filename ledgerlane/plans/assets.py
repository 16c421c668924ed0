"""Straight-line depreciation of fixed assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.ids import row_id
from ledgerlane.functions.money import MONEY

# Fixed value: the message for assets that already have booked depreciation.
LOCKED_MESSAGE = "ERROR: Ya hay depreciaciones contabilizadas"

ASSET = ["company_key", "item_id"]

# Within 24 months a common-year February passes; no month is shorter, so the day of month cannot drop further.
_DAY_SETTLED_AFTER = 24


def _month_end(start: Column, months: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(start, "month"), months))


def instalment_date(start: Column, number: Column) -> Column:
    """``start`` moved on by one month ``number`` times.

    Each step keeps the day or falls back to the month's last day, and a lost day never returns: 31 January, 29 February,
    29 March. So the day is the smallest of the start day and the lengths of all months passed; looking at the
    first 24 of them is enough.
    """
    lengths = F.transform(
        F.sequence(F.lit(1), F.least(number, F.lit(_DAY_SETTLED_AFTER))), lambda step: F.day(_month_end(start, step))
    )
    first = F.add_months(F.trunc(start, "month"), number)
    clamped = F.date_add(first, F.least(F.day(start), F.array_min(lengths)) - 1)
    return F.when(F.day(start) <= 28, F.add_months(start, number)).otherwise(clamped)


def depreciation_schedule(items: DataFrame) -> DataFrame:
    """The monthly instalments of every asset in ``items``, computed row by row without a shuffle.

    The last instalment is corrected when the instalments exceed the base (it may turn negative); a shortfall stays
    open. Assets without a positive number of months have no instalments.
    """
    number = F.col("number")
    assets = items.where(F.col("item_fixed_asset_depreciation_months") >= 1).select(
        "company_key",
        F.col("id").alias("item_id"),
        F.col("item_fixed_asset_base_depreciation").alias("base"),
        F.col("item_fixed_asset_depreciation_monthly").alias("monthly"),
        F.col("item_fixed_asset_depreciation_months").alias("months"),
        F.col("item_fixed_asset_depreciation_start_date").alias("start"),
    )
    instalments = assets.withColumn("number", F.explode(F.sequence(F.lit(1), F.col("months"))))
    reached = (F.col("monthly") * number).cast(MONEY)
    exceeded = (number == F.col("months")) & (reached > F.col("base"))
    return instalments.select(
        *ASSET,
        F.lit(True).alias("is_enabled"),
        F.lit(False).alias("is_disabled"),
        F.lit(False).alias("is_revaluation"),
        F.when(exceeded, F.col("monthly") + (F.col("base") - reached))
        .otherwise(F.col("monthly"))
        .cast(MONEY)
        .alias("depreciation_monthly"),
        F.when(exceeded, F.col("base")).otherwise(reached).cast(MONEY).alias("depreciation_accumulated"),
        instalment_date(F.col("start"), number).alias("depreciation_date"),
    )


def locked_assets(log: DataFrame) -> DataFrame:
    """Assets with a booked or finished log row."""
    return log.where(F.col("document_id").isNotNull() | F.col("is_done")).select(*ASSET).distinct()


def rebuild_depreciation_log(items: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replace the open log rows of every asset in ``items`` by its schedule.

    Returns the whole new log and the rejected assets. Items without a number of months are no assets. An asset with
    booked depreciation is rejected and its rows stay untouched; a row whose done flag is NULL is neither open nor a lock,
    so it stays too.
    """
    assets = items.where(F.col("item_fixed_asset_depreciation_months").isNotNull()).withColumn("item_id", F.col("id"))
    locked = locked_assets(log)
    free = assets.join(locked, ASSET, "left_anti")
    rejects = assets.join(locked, ASSET, "left_semi").select(*ASSET, F.lit(LOCKED_MESSAGE).alias("message"))

    open_row = F.col("document_id").isNull() & F.coalesce(~F.col("is_done"), F.lit(False))
    # Only open rows are shuffled for the join; all others pass straight through.
    kept_open = log.where(open_row).join(free.select(*ASSET), ASSET, "left_anti")
    kept = log.where(~open_row).unionByName(kept_open.select(*log.columns))
    # An asset has at most one instalment on a date, so asset and date name the row.
    fresh = depreciation_schedule(free.drop("item_id")).withColumn("id", row_id("erp_log_fixed_asset", *ASSET, "depreciation_date"))
    unset = [field for field in log.schema.fields if field.name not in fresh.columns]
    fresh = fresh.withColumns({field.name: F.lit(None).cast(field.dataType) for field in unset})
    return kept.unionByName(fresh.select(*log.columns)), rejects
