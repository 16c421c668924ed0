"""Every job as a named query over the star-schema sample."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    TimestampNTZType,
    TimestampType,
)

from ledgerlane.functions.ids import row_id
from ledgerlane.operators.combinations import combination_counts, combinations, ragged_combinations, ragged_counts
from ledgerlane.operators.diff import snapshot_diff
from ledgerlane.operators.interval import DaySpans, join_intervals
from ledgerlane.operators.replace import replace_into
from ledgerlane.plans import assets, closures, corrections, crm, inventory, job_queue, pos_month, sales, tenants
from ledgerlane.session import prepare
from ledgerlane.sources.bucketed import bucketed
from ledgerlane.sources.collation import join_collated, sum_collated
from ledgerlane.sources.odd_sample import OddTables
from ledgerlane.sources.reconcile import reconciled, type_drift
from ledgerlane.sources.sample import RegisterTables, SampleTables
from ledgerlane.sources.tables import TENANT

Query = Callable[[SparkSession, str], DataFrame]

FROM = date(1998, 6, 1)
PERIOD = (datetime(1998, 1, 1), datetime(1998, 12, 31, 23, 59, 59))
REOPEN = {"company_key": 2, "register_id": "7", "date_from": date(2024, 1, 15)}
AXES = ("type", "size", "band")

_REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types for comparing with another engine: amounts as doubles, dates, times and flags as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        match field.dataType:
            case DecimalType():
                column = column.cast("decimal(28,6)").cast("double")
            case DateType() | BooleanType():
                column = column.cast("string")
            case IntegerType():
                column = column.cast("bigint")
            case TimestampType() | TimestampNTZType():
                text = column.cast("string")
                column = F.concat(
                    F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0")
                )
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(function: Callable[[SampleTables], DataFrame]) -> Callable[[SampleTables], DataFrame]:
    _REGISTRY[function.__name__] = lambda spark, sf_dir: comparable(function(SampleTables(prepare(spark), sf_dir)))
    return function


def register_query(function: Callable[[RegisterTables], DataFrame]) -> Callable[[RegisterTables], DataFrame]:
    _REGISTRY[function.__name__] = lambda spark, sf_dir: comparable(function(RegisterTables(prepare(spark), sf_dir)))
    return function


def odd_query(function: Callable[[OddTables], DataFrame]) -> Callable[[OddTables], DataFrame]:
    _REGISTRY[function.__name__] = lambda spark, sf_dir: comparable(function(OddTables(prepare(spark), sf_dir)))
    return function


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# Document eligibility and amounts ---------------------------------------------------------------------------------


def _eligible(tables: SampleTables, kinds, **filters) -> DataFrame:
    parts = []
    for kind in kinds:
        spec = sales.KINDS[kind]
        documents = sales.eligible_documents(tables[spec.table], kind, **filters)
        parts.append(
            documents.select(
                F.lit(kind).alias("kind"),
                *("id", "company_key", "branch_id", "person_id_seller"),
                spec.on("date").alias("document_date"),
                sales.header_amount(kind).alias("net_amount"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def eligible_documents(t):
    return _eligible(t, sales.ERP_KINDS).drop("net_amount")


@query
def eligible_documents_year_and_month(t):
    return _eligible(t, sales.ERP_KINDS, company_key=2, date_from=FROM).drop("net_amount")


@query
def eligible_documents_since(t):
    return _eligible(t, sales.ERP_KINDS, date_from=FROM, date_filter="since").drop("net_amount")


@query
def eligible_pos_documents(t):
    return _eligible(t, sales.POS_KINDS, date_from=FROM).drop("net_amount")


@query
def net_header_amounts(t):
    return _eligible(t, sales.ERP_KINDS).select("kind", "id", "net_amount")


@query
def net_detail_amounts(t):
    return sales.item_lines(t)


# Consolidated sales -----------------------------------------------------------------------------------------------


@query
def sales_by_branch(t):
    return sales.sales_by_branch(t)


@query
def sales_by_branch_from(t):
    return sales.sales_by_branch(t, company_key=1, date_from=FROM)


@query
def sales_by_seller(t):
    return sales.sales_by_seller(t)


@query
def sales_by_item(t):
    return sales.sales_by_item(t)


@query
def sales_by_item_from(t):
    return sales.sales_by_item(t, date_from=FROM)


@query
def pos_sales_by_branch(t):
    return sales.pos_sales_by_branch(t)


@query
def pos_sales_by_seller(t):
    return sales.pos_sales_by_seller(t)


@query
def pos_sales_by_item(t):
    return sales.pos_sales_by_item(t)


@query
def pos_month_by_branch(t):
    return pos_month.month_branches(pos_month.staged_sales(t, 1, 1998, 6))


@query
def pos_month_by_seller(t):
    return pos_month.month_sellers(pos_month.staged_sales(t, 1, 1998, 6))


@query
def pos_month_by_item(t):
    return pos_month.month_items(t, 1, 1998, 6)


@query
def replace_sales_report(t):
    """The POS report with the days of the ERP report since 1998-06 replaced."""
    source = sales.sales_by_branch(t, date_from=FROM, date_filter="since")
    return replace_into(sales.pos_sales_by_branch(t), source, sales.BRANCH_KEY)


# Register closures ------------------------------------------------------------------------------------------------


def _spans(t: RegisterTables) -> DaySpans:
    return closures.closure_spans(closures.recent_closures(t["erp_pos_register_closures"]))


def _invoices(t: RegisterTables) -> DataFrame:
    return closures.attach_invoices(_spans(t), t["erp_pos_invoice"])


def _expenses(t: RegisterTables) -> DataFrame:
    return closures.attach_expenses(_spans(t), t["erp_pos_expenses"])


@register_query
def closure_invoices(t):
    return _invoices(t).select("register_closure_id", "id", "invoice_type")


@register_query
def closure_expenses(t):
    return _expenses(t).select("register_closure_id", "event_id", "expense_amount")


@register_query
def closure_payments(t):
    return closures.explode_payments(_invoices(t))


@register_query
def closure_payment_totals(t):
    return closures.payment_totals(closures.explode_payments(_invoices(t))).drop("cash_total")


@register_query
def closure_payment_references(t):
    return closures.payment_references(closures.explode_payments(_invoices(t)))


@register_query
def closure_cash_totals(t):
    return closures.cash_totals(closures.explode_payments(_invoices(t)))


@register_query
def closure_payments_json(t):
    return closures.payments_json(closures.payment_totals(closures.explode_payments(_invoices(t))))


@register_query
def closure_taxes(t):
    return closures.explode_taxes(_invoices(t))


@register_query
def closure_taxes_real_names(t):
    return closures.explode_taxes(_invoices(t), real_tax_names=True)


@register_query
def closure_tax_totals(t):
    return closures.tax_totals(closures.explode_taxes(_invoices(t))).drop("tax_sum", "tax_sub")


@register_query
def closure_taxes_json(t):
    return closures.taxes_json(closures.tax_totals(closures.explode_taxes(_invoices(t))))


@register_query
def closure_expense_totals(t):
    return closures.expense_totals(_expenses(t))


@register_query
def rebuild_closures(t):
    return closures.rebuild_closures(t)[0]


@register_query
def rebuild_closures_one_row(t):
    return closures.rebuild_closures(t, cash_grain="closure")[0]


@register_query
def closure_jobs(t):
    return job_queue.closure_jobs(t["erp_pos_register_closures"], since=date(2024, 1, 15))


# Serial stock and fixed assets ------------------------------------------------------------------------------------


@query
def broken_serials(t):
    return inventory.broken_serials(t, ordered=True)


@query
def serial_inventory_flow(t):
    return inventory.serial_inventory_flow(t, headings=True)


@query
def depreciation_schedule(t):
    return assets.depreciation_schedule(t["erp_item"])


@query
def depreciation_log(t):
    """The new log; the fresh ids are random and shown as empty."""
    log, _ = assets.rebuild_depreciation_log(t["erp_item"], t["erp_log_fixed_asset"])
    return log.withColumn("id", F.when(F.col("id").startswith("L"), F.col("id")).otherwise("")).drop("document_id")


@query
def depreciation_rejects(t):
    return assets.rebuild_depreciation_log(t["erp_item"], t["erp_log_fixed_asset"])[1]


# CRM --------------------------------------------------------------------------------------------------------------


@query
def won_deals(t):
    return crm.won_deals(t, None, *PERIOD)


@query
def new_contacts(t):
    return crm.new_contacts(t, None, *PERIOD)


@query
def leads_with_origin(t):
    return crm.leads_with_origin(t, None, *PERIOD)


# Corrections ------------------------------------------------------------------------------------------------------


@register_query
def closure_document_descriptions(t):
    return corrections.propagate_closure_descriptions(t)[0]


@register_query
def closure_detail_descriptions(t):
    return corrections.propagate_closure_descriptions(t)[1]


@register_query
def reopened_invoices(t):
    return corrections.reopen_register(t, **REOPEN)["erp_pos_invoice"].select("id", "register_id", "invoice_status")


@register_query
def reopened_credit_notes(t):
    return corrections.reopen_register(t, **REOPEN)["erp_pos_credit_notes"].select(
        "id", "register_id", "credit_note_is_closed"
    )


@register_query
def reopened_advances(t):
    return corrections.reopen_register(t, **REOPEN)["erp_pos_advances"].select(
        "event_id", "register_id", "advance_is_closed"
    )


@register_query
def reopened_expenses(t):
    return corrections.reopen_register(t, **REOPEN)["erp_pos_expenses"].select(
        "event_id", "register_id", "expense_is_readonly"
    )


@register_query
def reopened_counts(t):
    return corrections.reopen_counts(t, **REOPEN)


# Tenants ----------------------------------------------------------------------------------------------------------


def _tenant_invoices(t: RegisterTables) -> DataFrame:
    return t.register_invoices(keep_snake=False).select(
        TENANT, "id", "register_id", "person_id_seller", "invoice_status", "invoice_payment_types"
    )


@register_query
def column_drift(t):
    return tenants.column_drift(_tenant_invoices(t))


@register_query
def column_drift_between(t):
    return tenants.column_drift(_tenant_invoices(t), present_in="erp_1001", missing_in="erp_1004")


@register_query
def payload_key_drift(t):
    return tenants.payload_key_drift(_tenant_invoices(t), "invoice_payment_types")


@register_query
def payload_key_drift_between(t):
    return tenants.payload_key_drift(
        _tenant_invoices(t), "invoice_payment_types", present_in="erp_1002", missing_in="erp_1005"
    )


@query
def find_people_by_id(t):
    """The people, of every company, who placed an urgent order that is still pending."""
    urgent = t.raw("orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    ids = urgent.select(F.col("o_custkey").cast("string")).distinct()
    return tenants.find_by_id(t["common_person"], ids).select("id", "company_key", "person_name", "person_state_id")


# Combinations and differences -------------------------------------------------------------------------------------


@query
def option_combination_counts(t):
    return combination_counts(t.options(), AXES)


@query
def option_combinations(t):
    return combinations(t.options(), AXES).withColumn("combination", F.concat_ws("|", "combination"))


@query
def customer_differences(t):
    return snapshot_diff(t.customers(), t.customers(changed=True), ["c_custkey"])


@query
def customer_differences_nested(t):
    return snapshot_diff(t.customers(nested=True), t.customers(changed=True, nested=True), ["c_custkey"])


# Rare cases ---------------------------------------------------------------------------------------------------------


@odd_query
def replace_sales_report_extra_column(t):
    """As ``replace_sales_report``, with a column that only the old report has and one that only the new one has."""
    source = sales.sales_by_branch(t, date_from=FROM, date_filter="since").withColumn("origin", F.lit("ERP"))
    target = sales.pos_sales_by_branch(SampleTables(t.spark, t.sf_dir)).withColumn("note", F.concat(F.lit("N"), F.col("branch_id")))
    return replace_into(target, source, sales.BRANCH_KEY)


@odd_query
def closure_invoices_shifted(t):
    return _invoices(t).select("register_closure_id", "id", "invoice_type")


@odd_query
def closure_expenses_shifted(t):
    return _expenses(t).select("register_closure_id", "event_id", "expense_amount")


@odd_query
def closure_payments_odd(t):
    spans = closures.closure_spans(t.closures())
    return closures.explode_payments(closures.attach_invoices(spans, t["erp_pos_invoice"]))


@odd_query
def closure_payload_rejects(t):
    rejects = closures.rebuild_closures(t)[1]
    return rejects.select("id", "company_key", F.concat_ws("|", "payloads").alias("payloads"))


@odd_query
def closure_jobs_of_tenants(t):
    return job_queue.closure_jobs(t.closures(), since=date(2024, 1, 15), tenants=["erp_1002", "erp_1005", "erp_9999"])


@odd_query
def broken_serials_of_company(t):
    return inventory.broken_serials(t, company_key=1)


@odd_query
def serial_inventory_flow_of_company(t):
    """The listing of one company; the ties that movements without a serial would make are left to the numbering."""
    return inventory.serial_inventory_flow(t, company_key=1, headings=True)


@odd_query
def serial_flow_rejects(t):
    return inventory.flow_rejects(t)


@odd_query
def depreciation_rejects_linked(t):
    return assets.rebuild_depreciation_log(t.items(), t["erp_log_fixed_asset"])[1]


@odd_query
def new_contacts_of_company(t):
    return crm.new_contacts(SampleTables(t.spark, t.sf_dir), 1, *PERIOD)


@odd_query
def closure_descriptions_of_register(t):
    registers = RegisterTables(t.spark, t.sf_dir)
    return corrections.propagate_closure_descriptions(registers, company_key=2, register_id="7")[0]


@odd_query
def column_drift_stored(t):
    return tenants.column_drift(t.stored_tenant_invoices().select(TENANT, "id", "person_id_seller", "loyalty_code"))


@odd_query
def find_people_by_list(t):
    people = tenants.find_by_id(t["common_person"], [str(number) for number in range(1, 60, 7)])
    return people.select("id", "company_key", "person_name", "person_state_id")


@odd_query
def option_combinations_gaps(t):
    return combinations(t.gappy_options(), AXES).withColumn("combination", F.concat_ws("|", "combination"))


@odd_query
def option_combination_counts_gaps(t):
    return combination_counts(t.gappy_options(), AXES)


@odd_query
def customer_differences_restructured(t):
    return snapshot_diff(t.restructured_customers(), t.restructured_customers(changed=True), ["c_custkey"])


@odd_query
def invoice_payload_differences(t):
    return snapshot_diff(t.payload_snapshot(), t.payload_snapshot(changed=True), ["id"])


@query
def customer_differences_by_hash(t):
    return snapshot_diff(t.customers(nested=True), t.customers(changed=True, nested=True), ["c_custkey"], by_hash=True)


@odd_query
def column_type_drift(t):
    return type_drift(t.spark, t.drifted_invoices())


@odd_query
def reconciled_invoices(t):
    return reconciled(t.spark, t.drifted_invoices()).frame


@odd_query
def reconciled_invoice_losses(t):
    return reconciled(t.spark, t.drifted_invoices()).lost


@odd_query
def option_combinations_ragged(t):
    return ragged_combinations(*t.ragged_options()).withColumn("combination", F.concat_ws("|", "combination"))


@odd_query
def option_combination_counts_ragged(t):
    return ragged_counts(*t.ragged_options())


@query
def sales_report_ids(t):
    """Ids of the seller report's rows."""
    return sales.with_row_ids(sales.sales_by_seller(t), "consolidated_sales_seller", sales.SELLER_KEY).select("id", *sales.SELLER_KEY)


@odd_query
def movement_ids(t):
    """Ids of serial movements, whose serial and document may be NULL, next to a movement they share everything else with."""
    rows = t.movements_of_two_companies().select("company_key", "inventory_id", "item_id", "item_serial_number").distinct()
    return rows.select(row_id("erp_inventory_detail", *rows.columns).alias("id"), "*")


@query
def sales_reports_together(t):
    """The branch and seller rows of one aggregation, and the item rows."""
    return _one_table(sales.sales_reports(t))


@query
def pos_sales_reports_together(t):
    return _one_table(sales.pos_sales_reports(t))


def _one_table(reports) -> DataFrame:
    named = [frame.withColumn("report", F.lit(name)) for name, frame in zip(("branch", "seller", "item"), reports)]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), named)


@query
def sales_by_item_bucketed(t):
    """The item report over headers and details stored in buckets of the document id."""
    specs = [sales.KINDS[kind] for kind in sales.ERP_KINDS]
    keys = {spec.table: "id" for spec in specs} | {spec.detail_table: "biz_document_id" for spec in specs}
    return sales.sales_by_item(bucketed(t.spark, t, keys))


@odd_query
def eligible_documents_collated(t):
    return sales.eligible_documents_collated(t.spelled_invoices(), "invoice").select("id", "company_key", "person_id_seller")


@odd_query
def sales_by_branch_collated(t):
    """Invoices per branch, whose name is spelled in several ways."""
    rows = sales.eligible_documents_collated(t.spelled_invoices(), "invoice").withColumn("net_amount", sales.header_amount("invoice"))
    return sum_collated(rows, ["branch_id"], ["net_amount"], others=["company_key"])


@odd_query
def people_of_states_collated(t):
    """People with the name of their state, which the two tables spell differently."""
    states = t["common_person_state"].select(F.translate(F.lower("id"), "aeiou", "áéíóú").alias("person_state_id"), "person_state_name")
    return join_collated(t["common_person"].select("id", "person_state_id"), states, ["person_state_id"])


@register_query
def closure_reference_lists(t):
    return closures.reference_lists(closures.explode_payments(_invoices(t)), size=20)


def _joined_by(t: OddTables, by: str) -> DataFrame:
    spans, invoices = _spans(t), t["erp_pos_invoice"]
    return join_intervals(spans, invoices, closures.REGISTER, "invoice_created_at", by).select("register_closure_id", "id", "invoice_type")


@odd_query
def closure_invoices_by_blocks(t):
    """Closures of days, and of centuries, whose invoices are found through blocks of time."""
    return _joined_by(t, "blocks")


@odd_query
def closure_invoices_by_days(t):
    return _joined_by(t, "days")
