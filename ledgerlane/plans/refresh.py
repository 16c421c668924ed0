"""Refresh of the published sales reports: one call per report family, from the tables to the published version."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from ledgerlane.plans import sales
from ledgerlane.sources.publish import scratch_scope, upsert_published_set
from ledgerlane.sources.tables import Tables

# Report folder -> job and key.
ERP_REPORTS = {
    "consolidated_sales_branch": (sales.sales_by_branch, sales.BRANCH_KEY),
    "consolidated_sales_seller": (sales.sales_by_seller, sales.SELLER_KEY),
    "consolidated_sales_item": (sales.sales_by_item, sales.ITEM_KEY),
}
POS_REPORTS = {
    "consolidated_sales_branch_pos": (sales.pos_sales_by_branch, sales.BRANCH_KEY),
    "consolidated_sales_seller_pos": (sales.pos_sales_by_seller, sales.SELLER_KEY),
    "consolidated_sales_item_pos": (sales.pos_sales_by_item, sales.ITEM_KEY),
}


def _refresh(reports: dict, job: Callable, tables: Tables, root: str, company_key: int | None, date_from: date | None) -> str:
    """Compute the reports of a family from one pass over its documents and replace their keys in the published ones, all in one version."""
    spark = next(iter(tables[table] for table in ("erp_invoice", "erp_pos_invoice"))).sparkSession
    with scratch_scope(spark):
        frames = job(tables, company_key=company_key, date_from=date_from)
        keys = {name: key for name, (_, key) in reports.items()}
        sources = {name: sales.with_row_ids(frame, name, key) for (name, key), frame in zip(keys.items(), frames)}
        return upsert_published_set(sources, root, keys)


def refresh_sales_reports(tables: Tables, root: str, company_key: int | None = None, date_from: date | None = None) -> str:
    """Branch, seller and item reports of the ERP documents; read one with ``read_current(spark, root, name)``. Returns the new version."""
    return _refresh(ERP_REPORTS, sales.sales_reports, tables, f"{root}/erp", company_key, date_from)


def refresh_pos_sales_reports(tables: Tables, root: str, company_key: int | None = None, date_from: date | None = None) -> str:
    """Branch, seller and item reports of the POS documents, likewise."""
    return _refresh(POS_REPORTS, sales.pos_sales_reports, tables, f"{root}/pos", company_key, date_from)
