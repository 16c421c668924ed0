"""Cash-register closures rebuilt from invoices, their JSON payments and taxes, and expenses."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.money import MONEY, no_money, or_zero
from ledgerlane.functions.payload import (
    PAYMENT_FIELDS,
    allow_repeated_keys,
    elements,
    entry,
    is_malformed,
    json_value,
    read_fields,
    tax_fields,
)
from ledgerlane.operators.interval import DaySpans, day_spans, join_intervals
from ledgerlane.operators.numbering import number_rows
from ledgerlane.sources.tables import Tables

# Invoice types of a closure, and the suffix their output columns carry.
SALE, REFUND = "IN", "RF"
SUFFIXES = {SALE: "", REFUND: "_refund"}

# Fixed value: closures created before this day are never rebuilt.
SINCE = date(2022, 6, 1)

REGISTER = ["company_key", "branch_id", "register_id"]

CashGrain = Literal["payment_type", "closure"]

# Output key -> source column of the JSON arrays written per closure.
PAYMENT_JSON = {
    "paymentTypeCode": "payment_type_code",
    "paymentTypeName": "payment_type_name",
    "paymentTypeIsCash": "payment_type_is_cash",
    "accountCode_Bankcash": "account_code_bankcash",
    "accountName_Bankcash": "account_name_bankcash",
    "invoicePaymentValue": "invoice_payment_value",
    "invoicePaymentReference": None,
}
TAX_JSON = {
    "taxId": "tax_id",
    "taxName": "tax_name",
    "taxCategory": "tax_category",
    "taxIsSum": "tax_is_sum",
    "taxPercentValue": "tax_percent_value",
    "taxBase": "tax_base",
    "taxIsDiscriminate": "tax_is_discriminate",
    "taxExemptionReason": "tax_exemption_reason",
    "_SubTotal": "sub_total",
    "_ValueTotal": "value_total",
}
_JSON_TEXT = {field.name for field in (*PAYMENT_FIELDS, *tax_fields()) if field.kind == "json"}

Getter = Callable[[str], Column]


def recent_closures(closures: DataFrame, since: date = SINCE) -> DataFrame:
    return closures.where(F.col("register_closure_created_at") >= F.lit(since).cast("timestamp_ntz"))


def closure_spans(closures: DataFrame) -> DaySpans:
    """The opening times of closures, prepared once for attaching invoices and expenses."""
    opened = closures.select(
        F.col("id").alias("register_closure_id"), *REGISTER, "register_opened_at", "register_closure_created_at"
    )
    return day_spans(opened, "register_opened_at", "register_closure_created_at")


def attach_to_closures(spans: DaySpans, rows: DataFrame, at: str) -> DataFrame:
    """Each row with the closure of its register that was open at its time.

    Both ends count, so a row on the boundary of two closures belongs to both.
    """
    return join_intervals(spans, rows, REGISTER, at).drop("register_opened_at", "register_closure_created_at")


def attach_invoices(spans: DaySpans, invoices: DataFrame) -> DataFrame:
    return attach_to_closures(spans, invoices, "invoice_created_at")


def attach_expenses(spans: DaySpans, expenses: DataFrame) -> DataFrame:
    return attach_to_closures(spans, expenses, "expense_date_time")


def expense_totals(expenses: DataFrame) -> DataFrame:
    """Expense total per closure, from attached expenses."""
    return expenses.groupBy("register_closure_id").agg(
        F.sum("expense_amount").cast(MONEY).alias("expense_total")
    )


def explode_payments(invoices: DataFrame) -> DataFrame:
    """One row per payment of attached sale and refund invoices; NULL, empty or malformed payloads give none."""
    return _explode(invoices, "invoice_payment_types", PAYMENT_FIELDS)


def explode_taxes(invoices: DataFrame, real_tax_names: bool = False) -> DataFrame:
    """One row per tax of attached sale and refund invoices."""
    return _explode(invoices, "invoice_taxes", tax_fields(real_tax_names))


def _explode(invoices: DataFrame, payload: str, fields) -> DataFrame:
    return (
        allow_repeated_keys(invoices)
        .where(F.col("invoice_type").isin(*SUFFIXES))
        .select("register_closure_id", "invoice_type", F.explode(elements(F.col(payload))).alias("element"))
        .select("register_closure_id", "invoice_type", entry(F.col("element")).alias("entry"))
        .select("register_closure_id", "invoice_type", *read_fields(F.col("entry"), fields))
    )


def payload_rejects(invoices: DataFrame) -> DataFrame:
    """Invoices whose payment or tax payload is not JSON; they would have aborted the rebuild."""
    bad = F.array_compact(
        F.array(
            *[
                F.when(is_malformed(F.col(name)), F.lit(name))
                for name in ("invoice_payment_types", "invoice_taxes")
            ]
        )
    )
    return allow_repeated_keys(invoices).select("id", "company_key", bad.alias("payloads")).where(F.size("payloads") > 0)


# What a payment total and a tax total are made of. Columns outside the group key are arbitrary: the smallest is kept.
_PAYMENT_TEXTS = ("payment_type_name", "account_code_bankcash", "account_name_bankcash")
_PAYMENT_LOWS = ("payment_type_is_cash",)
_PAYMENT_SUMS = ("invoice_payment_value",)
_TAX_TEXTS = ("tax_name", "tax_category", "tax_exemption_reason")
_TAX_LOWS = ("tax_is_sum", "tax_percent_value", "tax_base", "tax_is_discriminate")
_TAX_SUMS = ("sub_total", "value_total")


def _collapse(
    df: DataFrame,
    keys: Sequence[str],
    texts: Sequence[str],
    lows: Sequence[str],
    sums: Sequence[str],
    highs: Sequence[str] = (),
) -> DataFrame:
    """Per key the smallest of ``texts`` and ``lows``, the largest of ``highs`` and the totals of ``sums``.

    The smallest text would make Spark sort all rows. So the rows are first summed per key and texts, which hash
    aggregation does before and after the shuffle, and the texts are compared on the few rows left.
    """
    fixed = [
        *[F.min(name).alias(name) for name in lows],
        *[F.max(name).alias(name) for name in highs],
        *[F.sum(name).alias(name) for name in sums],
    ]
    fine = df.groupBy(*keys, *texts).agg(*fixed)
    return fine.groupBy(*keys).agg(*[F.min(name).alias(name) for name in texts], *fixed)


def _as_money(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(MONEY) for name in names})


def payment_totals(payments: DataFrame) -> DataFrame:
    """Totals per closure, invoice type and payment code. ``cash_total`` counts cash payments only, NULL without any."""
    keys = ("register_closure_id", "invoice_type", "payment_type_code")
    cash = F.when(F.col("payment_type_is_cash"), F.col("invoice_payment_value"))
    sums = (*_PAYMENT_SUMS, "cash_total")
    return _as_money(
        _collapse(payments.withColumn("cash_total", cash), keys, _PAYMENT_TEXTS, _PAYMENT_LOWS, sums), sums
    )


def payment_references(payments: DataFrame) -> DataFrame:
    """How often each reference occurs per closure, invoice type and payment code.

    The rebuilt closure always shows a NULL reference (as it always has); this frame keeps the references as rows
    instead of one list per payment code, which would have no size bound.
    """
    return (
        payments.where(F.col("invoice_payment_reference").isNotNull())
        .groupBy("register_closure_id", "invoice_type", "payment_type_code", "invoice_payment_reference")
        .agg(F.count("*").alias("occurrences"))
    )


def cash_totals(payments: DataFrame) -> DataFrame:
    """Cash total per closure, invoice type and payment code; codes without cash payments are left out."""
    return (
        payments.where("payment_type_is_cash")
        .groupBy("register_closure_id", "invoice_type", "payment_type_code")
        .agg(F.sum("invoice_payment_value").cast(MONEY).alias("invoice_payment_value"))
    )


def reference_lists(payments: DataFrame, size: int = 1000) -> DataFrame:
    """The references per closure, invoice type and payment code as ordered lists, cut into numbered pieces of at most ``size``.

    Pieces in the order of their number make up the whole list, which no task ever holds: references are numbered over the whole
    frame by a range sort, a group's pieces follow from where it begins, and each piece is put together on its own.
    """
    keys = ["register_closure_id", "invoice_type", "payment_type_code"]
    rows = payments.where(F.col("invoice_payment_reference").isNotNull()).select(*keys, "invoice_payment_reference")
    numbered = number_rows(rows, [F.col(name).asc_nulls_first() for name in (*keys, "invoice_payment_reference")])
    begins = numbered.groupBy(*keys).agg(F.min("idx").alias("begin"))
    begins = begins.withColumnsRenamed({name: f"_{name}" for name in keys})
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys])
    placed = numbered.join(begins, same).withColumn("place", F.col("idx") - F.col("begin"))
    pieces = placed.groupBy(*keys, F.call_function("div", F.col("place"), F.lit(size)).alias("piece"))
    entries = F.array_sort(F.collect_list(F.struct("place", "invoice_payment_reference")))
    joined = F.array_join(entries["invoice_payment_reference"], ",")
    return pieces.agg(F.count("*").alias("size"), F.concat(F.lit("["), joined, F.lit("]")).alias("payment_references"))


def tax_totals(taxes: DataFrame) -> DataFrame:
    """Totals per closure, invoice type and tax; a missing tax id is a group of its own.

    ``tax_sum`` and ``tax_sub`` split the tax value into taxes that are added and taxes that are withheld.
    """
    keys = ("register_closure_id", "invoice_type", "tax_id")
    added = {
        "tax_sum": F.when(F.col("tax_is_sum"), F.col("value_total")),
        "tax_sub": F.when(~F.col("tax_is_sum"), F.col("value_total")),
    }
    sums = (*_TAX_SUMS, *added)
    return _as_money(_collapse(taxes.withColumns(added), keys, _TAX_TEXTS, _TAX_LOWS, sums), sums)


def invoice_totals(invoices: DataFrame) -> DataFrame:
    """Header figures per closure and invoice type."""
    amounts = ("invoice_subtotal", "invoice_discount", "invoice_total")
    return invoices.groupBy("register_closure_id", "invoice_type").agg(
        F.min("invoice_consecutive").alias("invoice_consecutive_from"),
        F.max("invoice_consecutive").alias("invoice_consecutive_to"),
        F.count("id").alias("invoice_quantity"),
        *[F.sum(name).cast(MONEY).alias(name) for name in amounts],
    )


def _json_object(entry: Getter, layout: dict[str, str | None]) -> Column:
    def value(source: str | None) -> Column:
        if source is None:
            return F.lit(None).cast("string")
        return json_value(entry(source)) if source in _JSON_TEXT else entry(source)

    return F.struct(*[value(source).alias(key) for key, source in layout.items()])


def _json_array(entries: Column, layout: dict[str, str | None]) -> Column:
    """JSON text of an array of total records, ordered by their key; NULL when there are none."""
    objects = F.transform(F.sort_array(entries), lambda entry: _json_object(entry.getField, layout))
    return F.when(F.size(entries) > 0, F.to_json(objects, {"ignoreNullFields": "false"}))


def payments_json(totals: DataFrame) -> DataFrame:
    """JSON array of payment totals per closure and invoice type. One entry per payment code, so it stays small."""
    return _totals_json(totals, "payment_types_json", PAYMENT_JSON)


def taxes_json(totals: DataFrame) -> DataFrame:
    """JSON array of tax totals per closure and invoice type. One entry per tax, so it stays small."""
    return _totals_json(totals, "taxes_json", TAX_JSON)


def _totals_json(totals: DataFrame, name: str, layout: dict[str, str | None]) -> DataFrame:
    return (
        totals.groupBy("register_closure_id", "invoice_type")
        .agg(F.collect_list(_record(layout)).alias("entries"))
        .select("register_closure_id", "invoice_type", _json_array(F.col("entries"), layout).alias(name))
    )


def _record(layout: dict[str, str | None]) -> Column:
    return F.struct(*[F.col(source) for source in layout.values() if source is not None])


def _per_closure(totals: DataFrame, **columns: Column) -> DataFrame:
    """Totals per closure and invoice type as one row per closure, with the aggregate columns of every type side by side.

    Each column is an aggregate of values that :func:`_of_type` limits to one invoice type.
    """
    return totals.groupBy(F.col("register_closure_id").alias("id")).agg(
        *[column.alias(name) for name, column in columns.items()]
    )


def _of_type(kind: str, value: Column) -> Column:
    return F.when(F.col("invoice_type") == kind, value)


def closure_figures(invoices: DataFrame, real_tax_names: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Header, payment and tax figures, one row per closure each, from the attached invoices.

    Three independent branches: each scans only its own columns, carries only those through the join, sums before the
    shuffle, and can run beside the others. The lists hold one entry per payment code or tax of a closure.
    """
    headers = invoice_totals(invoices.where(F.col("invoice_type").isin(*SUFFIXES)))
    header_columns = [name for name in headers.columns if name not in ("register_closure_id", "invoice_type")]
    payments = payment_totals(explode_payments(invoices))
    taxes = tax_totals(explode_taxes(invoices, real_tax_names))
    cash = F.when(F.col("cash_total").isNotNull(), F.struct(F.col("cash_total").alias("value")))
    types = SUFFIXES.items()
    return (
        _per_closure(
            headers,
            **{f"{name}{suffix}": F.max(_of_type(kind, F.col(name))) for kind, suffix in types for name in header_columns},
        ),
        _per_closure(
            payments,
            **{f"_payments{suffix}": F.collect_list(_of_type(kind, _record(PAYMENT_JSON))) for kind, suffix in types},
            **{f"_cash{suffix}": F.collect_list(_of_type(kind, cash)) for kind, suffix in types},
        ),
        _per_closure(
            taxes,
            **{f"_taxes{suffix}": F.collect_list(_of_type(kind, _record(TAX_JSON))) for kind, suffix in types},
            **{
                f"invoice_{name}{suffix}": F.sum(_of_type(kind, F.col(name))).cast(MONEY)
                for kind, suffix in types
                for name in ("tax_sum", "tax_sub")
            },
        ),
    )


def rebuild_closures(
    tables: Tables,
    since: date = SINCE,
    cash_grain: CashGrain = "payment_type",
    real_tax_names: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The rebuilt closure records, and the invoices whose payloads are no JSON (see :func:`payload_rejects`).

    A rejected payload adds nothing to its closure, so closures are complete only if there are no rejects among their invoices.
    ``cash_grain="payment_type"`` keeps the established output: a closure with several cash payment codes appears
    once per pair of a sale code and a refund code, each row with the totals of its pair. ``"closure"`` gives one row
    per closure with its whole cash total.
    """
    closures = recent_closures(tables["erp_pos_register_closures"], since)
    spans = closure_spans(closures)
    invoices = attach_invoices(spans, tables["erp_pos_invoice"])
    expenses = expense_totals(attach_expenses(spans, tables["erp_pos_expenses"]))

    joined = closures.join(expenses.withColumnRenamed("register_closure_id", "id"), "id", "left")
    for figures in closure_figures(invoices, real_tax_names):
        joined = joined.join(figures, "id", "left")
    for suffix in SUFFIXES.values():
        totals = F.col(f"_cash{suffix}")
        if cash_grain == "payment_type":
            cash = F.explode_outer(totals)
        else:
            cash = F.struct(
                F.aggregate(totals, no_money(), lambda total, entry: (total + or_zero(entry["value"])).cast(MONEY))
                .alias("value")
            )
        joined = joined.withColumn(f"_paid{suffix}", cash)

    def counts(suffix: str) -> list[Column]:
        names = ("consecutive_from", "consecutive_to", "quantity")
        return [F.coalesce(f"invoice_{name}{suffix}", F.lit(0)).alias(f"invoice_{name}{suffix}") for name in names]

    def amounts(suffix: str) -> list[Column]:
        names = ("subtotal", "discount", "tax_sum", "tax_sub", "total")
        return [or_zero(F.col(f"invoice_{name}{suffix}")).alias(f"invoice_{name}{suffix}") for name in names]

    def arrays(suffix: str) -> list[Column]:
        return [
            _json_array(F.col(f"_taxes{suffix}"), TAX_JSON).alias(f"invoice_taxes{suffix}"),
            _json_array(F.col(f"_payments{suffix}"), PAYMENT_JSON).alias(f"invoice_payment_types{suffix}"),
        ]

    rebuilt = joined.select(
        "id",
        *("company_key", "register_id", "branch_id", "document_id", "document_id_refund"),
        *("register_closure_consecutive", "register_closure_date"),
        *("register_closure_done", "register_closure_exception"),
        or_zero(F.col("expense_total")).alias("register_closure_expense_total"),
        "register_closure_opening_balance",
        or_zero(F.col("_paid.value")).alias("register_closure_payment"),
        (-or_zero(F.col("_paid_refund.value"))).cast(MONEY).alias("register_closure_refund"),
        "register_closure_recount",
        *[
            column
            for suffix in SUFFIXES.values()
            for column in (*counts(suffix), *amounts(suffix), *arrays(suffix))
        ],
        *("register_opened_at", "register_closure_created_at", "register_closure_created_by"),
        *("register_closure_updated_at", "register_closure_updated_by"),
    )
    return rebuilt, payload_rejects(invoices.where(F.col("invoice_type").isin(*SUFFIXES)))
