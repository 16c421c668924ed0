"""POS sales of one company and month under the older rules: paid or closed sales, no e-invoicing or gift tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.conditions import every
from ledgerlane.functions.money import LINE, REPORT
from ledgerlane.plans.sales import KINDS, POS_KINDS, POS_SALE, pos_item_lines
from ledgerlane.sources.tables import Tables

# The invoice states that count as sold.
SOLD = ("PD", "CL")


def _documents(tables: Tables, kind: str, year: int, month: int, company_key: int | None) -> DataFrame:
    spec = KINDS[kind]
    tests = [spec.on("year") == year, spec.on("month") == month]
    if company_key is not None:
        tests.append(F.col("company_key") == company_key)
    if kind == "pos_invoice":
        tests += [F.col("invoice_type") == POS_SALE, F.col("invoice_status").isin(*SOLD)]
    return tables[spec.table].where(every(tests))


def _totals(lines: DataFrame, *keys: str, to: str = REPORT) -> DataFrame:
    return lines.groupBy(*keys, "sales_date").agg(
        F.sum("sales_total").cast(to).alias("sales_total"),
        F.sum("sales_total_refund").cast(to).alias("sales_total_refund"),
        *[F.min(f"sales_{part}").alias(f"sales_{part}") for part in ("year", "month", "day")],
    )


def staged_sales(tables: Tables, company_key: int, year: int, month: int) -> DataFrame:
    """Totals per branch, seller and date: the small frame both roll-ups read."""
    parts = []
    nothing = F.lit(0).cast(LINE)
    for kind in POS_KINDS:
        spec = KINDS[kind]
        subtotal = spec.on("subtotal").cast(LINE)
        sale, refund = (nothing, subtotal) if spec.refund else (subtotal, nothing)
        parts.append(
            _documents(tables, kind, year, month, company_key).select(
                "company_key",
                "branch_id",
                "person_id_seller",
                sale.alias("sales_total"),
                refund.alias("sales_total_refund"),
                *[spec.on(part).alias(f"sales_{part}") for part in ("date", "year", "month", "day")],
            )
        )
    return _totals(reduce(DataFrame.unionByName, parts), "company_key", "branch_id", "person_id_seller", to=LINE)


def month_branches(staging: DataFrame) -> DataFrame:
    return _totals(staging, "company_key", "branch_id")


def month_sellers(staging: DataFrame) -> DataFrame:
    """Sales without a seller are left out."""
    return _totals(staging.where(F.col("person_id_seller").isNotNull()), "company_key", "person_id_seller")


def month_items(tables: Tables, company_key: int, year: int, month: int) -> DataFrame:
    """Totals per branch, item and date. The company test is on the lines, and a line without amount counts as 0."""
    parts = []
    for kind in POS_KINDS:
        headers = _documents(tables, kind, year, month, company_key=None)
        parts.append(pos_item_lines(tables, kind, headers, company_key, gifts=True))
    lines = reduce(DataFrame.unionByName, parts).fillna(0, ["sales_total", "sales_total_refund"])
    return _totals(lines, "company_key", "branch_id", "item_id")


def pos_month_rebuild(tables: Tables, company_key: int, year: int, month: int) -> dict[str, DataFrame]:
    """The three month reports: ``branch``, ``seller`` and ``item``.

    The staging frame is a few rows per branch, seller and day, over one month of partitions. It is marked for reuse,
    so writing ``branch`` and then ``seller`` scans the documents once; call ``unpersist`` on ``staging`` after both.
    """
    staging = staged_sales(tables, company_key, year, month).persist()
    return {
        "staging": staging,
        "branch": month_branches(staging),
        "seller": month_sellers(staging),
        "item": month_items(tables, company_key, year, month),
    }
