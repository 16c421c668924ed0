"""Consolidated sales of ERP documents: by branch, by seller and by item, per day.

Each report is one pass: eligible documents of the three kinds are unioned and summed with a single shuffle on the
report key, after map-side partial sums, so one company or branch holding most rows does not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.conditions import (
    PRODUCTION,
    DateFilter,
    e_invoicing_settled,
    every,
    for_company,
    in_period,
)
from ledgerlane.functions.ids import row_id
from ledgerlane.functions.money import LINE, REPORT, line_amount, net_detail_amount, net_header_amount
from ledgerlane.sources.collation import collated
from ledgerlane.sources.publish import store
from ledgerlane.sources.tables import Tables

# Fixed value: the seller that stands for "no seller".
NO_SELLER = "00000000-0000-0000-0000-000000000000"

# Document states.
VOIDED = "Anulada"
POS_SALE = "IN"
POS_UNFINISHED = ("OP", "Parked")

DAY = ["sales_year", "sales_month", "sales_day"]
BRANCH_KEY = ["company_key", "branch_id", *DAY]
SELLER_KEY = ["company_key", "person_id_seller", *DAY]
ITEM_KEY = ["company_key", "branch_id", "item_id", *DAY]


@dataclass(frozen=True)
class DocumentKind:
    """Where a kind of document lives and how its columns are called."""

    table: str
    detail_table: str
    dates: str
    states: str
    refund: bool
    pos: bool = False

    def on(self, part: str) -> Column:
        return F.col(f"{self.dates}_{part}")


# Tables and column prefixes per kind.
KINDS: dict[str, DocumentKind] = {
    "invoice": DocumentKind("erp_invoice", "erp_invoice_detail", "biz_document", "invoice", refund=False),
    "debit_note": DocumentKind(
        "erp_invoice_debit_note", "erp_invoice_debit_note_detail", "biz_document", "invoice_debit_note", refund=False
    ),
    "credit_note": DocumentKind(
        "erp_invoice_credit_note", "erp_invoice_credit_note_detail", "biz_document", "invoice_credit_note", refund=True
    ),
    "pos_invoice": DocumentKind(
        "erp_pos_invoice", "erp_pos_invoice_detail", "invoice", "invoice", refund=False, pos=True
    ),
    "pos_credit_note": DocumentKind(
        "erp_pos_credit_notes", "erp_pos_credit_note_details", "credit_note", "credit_note", refund=True, pos=True
    ),
}
ERP_KINDS = ("invoice", "debit_note", "credit_note")
POS_KINDS = ("pos_invoice", "pos_credit_note")

_REFUND_COLUMNS = (
    "biz_document_type_code",
    "biz_document_has_refund",
    "biz_document_refund_ingress",
    "biz_document_refund_discount",
)


def eligible_documents(
    df: DataFrame,
    kind: str,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
) -> DataFrame:
    """Documents of one kind that count as sales, with the columns the reports need.

    Plain filters on stored columns, so they reach the scan. A NULL state or status fails its test.
    """
    spec = KINDS[kind]
    tests = for_company(company_key, F.col("company_key"))
    tests += in_period(date_from, spec.on("date"), spec.on("year"), spec.on("month"), date_filter)
    tests.append(F.col("document_mode") == PRODUCTION)
    tests.append(e_invoicing_settled(F.col(f"{spec.states}_status_dian"), F.col(f"{spec.states}_state_dian")))
    if kind == "pos_invoice":
        tests += [F.col("invoice_type") == POS_SALE, ~F.col("invoice_status").isin(*POS_UNFINISHED)]
    elif not spec.pos:
        tests.append(F.col(f"{spec.states}_status") != VOIDED)
    columns = ["id", "company_key", "branch_id", "person_id_seller"]
    if kind == "invoice":
        columns += _REFUND_COLUMNS
    if not spec.pos:
        columns.append("biz_document_exchange_rate")
    columns += [f"{spec.dates}_{part}" for part in ("subtotal", "discount", "date", "year", "month", "day")]
    return df.where(every(tests)).select(*columns)


def eligible_documents_collated(df: DataFrame, kind: str, **filters) -> DataFrame:
    """As :func:`eligible_documents`, with modes and states compared without case and accents, as the source database does.

    The spellings of the document mode that occur are looked up first and filter the scan byte by byte.
    """
    states = [f"{KINDS[kind].states}_{part}" for part in ("status", "status_dian", "state_dian")]
    columns = [name for name in ("document_mode", "invoice_type", *states) if name in df.columns]
    return eligible_documents(collated(df, columns, {"document_mode": [PRODUCTION]}), kind, **filters)


def header_amount(kind: str) -> Column:
    """Net amount of one document. POS documents count their subtotal; their discount is not subtracted."""
    spec = KINDS[kind]
    if spec.pos:
        return spec.on("subtotal").cast(LINE)
    refunds = [F.col(name) for name in _REFUND_COLUMNS] if kind == "invoice" else []
    return net_header_amount(
        spec.on("subtotal"), spec.on("discount"), F.col("biz_document_exchange_rate"), *refunds
    )


def _sides(spec: DocumentKind, amount: Column) -> list[Column]:
    nothing = F.lit(0).cast(LINE)
    sale, refund = (nothing, amount) if spec.refund else (amount, nothing)
    return [sale.alias("sales_total"), refund.alias("sales_total_refund")]


def _header_sales(tables: Tables, kinds: Sequence[str], key: str, **filters) -> DataFrame:
    parts = []
    for kind in kinds:
        spec = KINDS[kind]
        documents = eligible_documents(tables[spec.table], kind, **filters)
        parts.append(
            documents.select(
                "company_key",
                key,
                *_sides(spec, header_amount(kind)),
                *[spec.on(part).alias(f"sales_{part}") for part in ("date", "year", "month", "day")],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def sum_sales(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals per key; the date is the earliest of the group (all dates of a group agree in clean data)."""
    return lines.groupBy(*keys).agg(
        F.sum("sales_total").cast(REPORT).alias("sales_total"),
        F.sum("sales_total_refund").cast(REPORT).alias("sales_total_refund"),
        F.min("sales_date").alias("sales_date"),
    )


def sales_by_branch(
    tables: Tables,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
) -> DataFrame:
    """Sales and refunds of invoices, debit and credit notes per company, branch and day."""
    lines = _header_sales(
        tables, ERP_KINDS, "branch_id", company_key=company_key, date_from=date_from, date_filter=date_filter
    )
    return sum_sales(lines, BRANCH_KEY)


def sales_by_seller(
    tables: Tables,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
) -> DataFrame:
    """Sales and refunds per company, seller and day; documents without a seller go to :data:`NO_SELLER`.

    When documents really carry :data:`NO_SELLER` as their seller, their row replaces the one of the documents without
    a seller, as the keyed replace of the report does. Both sums are kept side by side so that this needs no second shuffle.
    """
    lines = _header_sales(
        tables, ERP_KINDS, "person_id_seller", company_key=company_key, date_from=date_from, date_filter=date_filter
    )
    named = F.col("person_id_seller").isNotNull()

    def winning(function, name: str) -> Column:
        with_seller = function(F.when(named, F.col(name)))
        return F.when(F.count("person_id_seller") > 0, with_seller).otherwise(function(name))

    return lines.groupBy(
        "company_key", F.coalesce("person_id_seller", F.lit(NO_SELLER)).alias("person_id_seller"), *DAY
    ).agg(
        winning(F.sum, "sales_total").cast(REPORT).alias("sales_total"),
        winning(F.sum, "sales_total_refund").cast(REPORT).alias("sales_total_refund"),
        winning(F.min, "sales_date").alias("sales_date"),
    )


def item_lines(
    tables: Tables,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
    headers_of: Callable[[str], DataFrame] | None = None,
) -> DataFrame:
    """Detail lines of eligible ERP documents with their amounts; gifts are left out.

    Lines are filtered by their own company and date, which may differ from their document's. ``headers_of`` gives the eligible documents of a
    kind where they are at hand already; otherwise they are found in the tables.
    """
    parts = []
    for kind in ERP_KINDS:
        spec = KINDS[kind]
        headers = headers_of(kind) if headers_of else eligible_documents(tables[spec.table], kind, company_key, date_from, date_filter)
        kept = ["id", "branch_id", "biz_document_exchange_rate"]
        kept += ["biz_document_has_refund"] if kind == "invoice" else []

        day = {part: F.col(f"biz_document_detail_{part}") for part in ("date", "year", "month", "day")}
        tests = for_company(company_key, F.col("company_key"))
        tests += in_period(date_from, day["date"], day["year"], day["month"], date_filter)
        tests.append(~F.col("biz_document_detail_is_present"))
        details = tables[spec.detail_table].where(every(tests))

        refunds = (
            [
                F.col("biz_document_type_code"),
                F.col("biz_document_has_refund"),
                F.col("biz_document_detail_quantity_refund"),
            ]
            if kind == "invoice"
            else []
        )
        amount = net_detail_amount(
            F.col("biz_document_detail_quantity"),
            F.col("biz_document_detail_unit_value"),
            F.col("biz_document_exchange_rate"),
            F.col("biz_document_detail_is_present"),
            *refunds,
        )
        joined = details.join(headers.select(*kept), F.col("biz_document_id") == F.col("id"))
        parts.append(
            joined.select(
                "company_key",
                "branch_id",
                "item_id",
                *_sides(spec, amount),
                *[column.alias(f"sales_{part}") for part, column in day.items()],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def sales_by_item(
    tables: Tables,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
) -> DataFrame:
    """Sales and refunds per company, branch, item and day, from detail lines joined to their documents.

    A document holding a large share of all lines is split by the adaptive skew join; the sums after it are partial.
    """
    return sum_sales(item_lines(tables, company_key, date_from, date_filter), ITEM_KEY)


def pos_sales_by_branch(
    tables: Tables,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
) -> DataFrame:
    """POS sales and refunds per company, branch and day."""
    lines = _header_sales(
        tables, POS_KINDS, "branch_id", company_key=company_key, date_from=date_from, date_filter=date_filter
    )
    return sum_sales(lines, BRANCH_KEY)


def pos_sales_by_seller(
    tables: Tables,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
) -> DataFrame:
    """POS sales and refunds per company, seller and day; documents without a seller are left out."""
    lines = _header_sales(
        tables, POS_KINDS, "person_id_seller", company_key=company_key, date_from=date_from, date_filter=date_filter
    )
    return sum_sales(lines.where(F.col("person_id_seller").isNotNull()), SELLER_KEY)


def pos_item_lines(
    tables: Tables, kind: str, headers: DataFrame, company_key: int | None, gifts: bool
) -> DataFrame:
    """Detail lines of the given POS documents, dated by their document."""
    spec = KINDS[kind]
    tests = for_company(company_key, F.col("company_key"))
    if not gifts:
        tests.append(~F.col(f"{spec.dates}_detail_is_present"))
    details = tables[spec.detail_table].where(every(tests))
    amount = line_amount(F.col(f"{spec.dates}_detail_quantity"), F.col(f"{spec.dates}_detail_unit_value"))
    dated = headers.select(
        "id", "branch_id", *[spec.on(part).alias(f"sales_{part}") for part in ("date", "year", "month", "day")]
    )
    return details.join(dated, F.col(f"{spec.dates}_id") == F.col("id")).select(
        "company_key",
        "branch_id",
        "item_id",
        *_sides(spec, amount),
        "sales_date",
        *DAY,
    )


def pos_sales_by_item(
    tables: Tables,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
) -> DataFrame:
    """POS sales and refunds per company, branch, item and day; gifts are left out."""
    parts = []
    for kind in POS_KINDS:
        headers = eligible_documents(tables[KINDS[kind].table], kind, company_key, date_from, date_filter)
        parts.append(pos_item_lines(tables, kind, headers, company_key, gifts=False))
    return sum_sales(reduce(DataFrame.unionByName, parts), ITEM_KEY)


def eligible_headers(
    tables: Tables,
    kinds: Sequence[str] = ERP_KINDS,
    company_key: int | None = None,
    date_from: date | None = None,
    date_filter: DateFilter = "year_and_month",
) -> DataFrame:
    """The eligible documents of several kinds with their amounts, found once and stored: (kind, id, keys, amounts, day, what lines need)."""
    parts = []
    for kind in kinds:
        spec = KINDS[kind]
        documents = eligible_documents(tables[spec.table], kind, company_key, date_from, date_filter)
        refund = F.col("biz_document_has_refund") if kind == "invoice" else F.lit(None).cast("boolean")
        rate = F.lit(None) if spec.pos else F.col("biz_document_exchange_rate")
        parts.append(
            documents.select(
                F.lit(kind).alias("kind"),
                *("id", "company_key", "branch_id", "person_id_seller"),
                rate.cast(REPORT).alias("biz_document_exchange_rate"),
                refund.alias("biz_document_has_refund"),
                *_sides(spec, header_amount(kind)),
                *[spec.on(part).alias(f"sales_{part}") for part in ("date", "year", "month", "day")],
            )
        )
    return store(reduce(DataFrame.unionByName, parts), "headers")


def header_reports(headers: DataFrame, unnamed_seller: str | None = NO_SELLER) -> tuple[DataFrame, DataFrame]:
    """The branch and the seller report of :func:`eligible_headers`, from one aggregation by grouping sets, which is stored.

    Documents without a seller count for ``unnamed_seller``, as :func:`sales_by_seller` says, or are left out if that is None.
    """
    named = F.col("person_id_seller").isNotNull()
    lines = headers.withColumns({"named": named, "seller": F.coalesce("person_id_seller", F.lit(unnamed_seller).cast("string"))})
    sums = {"sales_total": F.sum, "sales_total_refund": F.sum, "sales_date": F.min}
    aggregates = [function(name).alias(name) for name, function in sums.items()]
    aggregates += [function(F.when(F.col("named"), F.col(name))).alias(f"named_{name}") for name, function in sums.items()]
    branch, seller = ["company_key", "branch_id", *DAY], ["company_key", "seller", *DAY]
    keys = ["company_key", "branch_id", "seller", *DAY]
    grouped = lines.groupingSets([[F.col(name) for name in branch], [F.col(name) for name in seller]], *keys).agg(
        F.grouping("branch_id").alias("by_seller"), F.count_if("named").alias("with_seller"), *aggregates
    )
    grouped = store(grouped, "grains")

    def report(rows: DataFrame, key: Sequence[str], value: Callable[[str], Column]) -> DataFrame:
        totals = [value(name).cast(REPORT).alias(name) for name in ("sales_total", "sales_total_refund")]
        return rows.select(*key, *totals, value("sales_date").alias("sales_date"))

    def winning(name: str) -> Column:
        return F.when(F.col("with_seller") > 0, F.col(f"named_{name}")).otherwise(F.col(name))

    sellers = grouped.where("by_seller = 1")
    sellers = sellers if unnamed_seller is not None else sellers.where("seller IS NOT NULL")
    sellers = sellers.withColumnRenamed("seller", "person_id_seller")
    return report(grouped.where("by_seller = 0"), BRANCH_KEY, F.col), report(sellers, SELLER_KEY, winning)


def sales_reports(
    tables: Tables, company_key: int | None = None, date_from: date | None = None, date_filter: DateFilter = "year_and_month"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The branch, seller and item reports together: every document and detail table is read once.

    Eligible documents are found once and stored with their amounts; branch and seller totals come from one aggregation over them, and the item
    lines are joined to them.
    """
    headers = eligible_headers(tables, ERP_KINDS, company_key, date_from, date_filter)

    def headers_of(kind: str) -> DataFrame:
        return headers.where(F.col("kind") == kind)

    branch, seller = header_reports(headers)
    return branch, seller, sum_sales(item_lines(tables, company_key, date_from, date_filter, headers_of), ITEM_KEY)


def pos_sales_reports(
    tables: Tables, company_key: int | None = None, date_from: date | None = None, date_filter: DateFilter = "year_and_month"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As :func:`sales_reports`, of the POS documents."""
    headers = eligible_headers(tables, POS_KINDS, company_key, date_from, date_filter)
    branch, seller = header_reports(headers, unnamed_seller=None)
    parts = []
    for kind in POS_KINDS:
        own = headers.where(F.col("kind") == kind)
        dated = own.withColumnsRenamed({f"sales_{part}": f"{KINDS[kind].dates}_{part}" for part in ("date", "year", "month", "day")})
        parts.append(pos_item_lines(tables, kind, dated, company_key, gifts=False))
    return branch, seller, sum_sales(reduce(DataFrame.unionByName, parts), ITEM_KEY)


def with_row_ids(report: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """A report with an ``id`` per row, as the report tables store it.

    The id follows from the table and the row's key, so a rerun, or a task that is computed again, gives every row the id it had.
    """
    return report.select(row_id(table, *key).alias("id"), "*")
