"""Column lists of the ERP tables the jobs read, as Spark DDL.

Fixed values: table and column names are the data contract of the jobs. Every table may also carry a
``tenant_db`` partition column naming the tenant database a row came from.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

#: The partition column.
TENANT = "tenant_db"

_ERP_DOCUMENT = """
    id string, company_key int, branch_id string, person_id_seller string,
    biz_document_exchange_rate decimal(20,6), biz_document_subtotal decimal(20,6), biz_document_discount decimal(20,6),
    biz_document_date date, biz_document_year int, biz_document_month int, biz_document_day int,
    document_mode string
"""

_ERP_DETAIL = """
    company_key int, biz_document_id string, item_id string, biz_document_detail_is_present boolean,
    biz_document_detail_quantity decimal(20,6), biz_document_detail_unit_value decimal(20,6),
    biz_document_detail_date date, biz_document_detail_year int, biz_document_detail_month int, biz_document_detail_day int
"""

TABLES: dict[str, str] = {
    "erp_invoice": _ERP_DOCUMENT
    + """, biz_document_type_code string, biz_document_has_refund boolean,
        biz_document_refund_ingress decimal(20,6), biz_document_refund_discount decimal(20,6),
        invoice_status string, invoice_status_dian string, invoice_state_dian string""",
    "erp_invoice_debit_note": _ERP_DOCUMENT
    + """, invoice_debit_note_status string, invoice_debit_note_status_dian string,
        invoice_debit_note_state_dian string""",
    "erp_invoice_credit_note": _ERP_DOCUMENT
    + """, invoice_credit_note_status string, invoice_credit_note_status_dian string,
        invoice_credit_note_state_dian string""",
    "erp_invoice_detail": _ERP_DETAIL
    + ", biz_document_type_code string, biz_document_detail_quantity_refund decimal(20,6)",
    "erp_invoice_debit_note_detail": _ERP_DETAIL,
    "erp_invoice_credit_note_detail": _ERP_DETAIL,
    "erp_pos_invoice": """
        id string, company_key int, branch_id string, register_id string, person_id_seller string,
        invoice_type string, invoice_status string, invoice_consecutive bigint,
        invoice_subtotal decimal(20,6), invoice_discount decimal(20,6), invoice_total decimal(20,6),
        invoice_date date, invoice_year int, invoice_month int, invoice_day int, invoice_created_at timestamp_ntz,
        invoice_payment_types string, invoice_taxes string,
        document_mode string, invoice_status_dian string, invoice_state_dian string""",
    "erp_pos_invoice_detail": """
        company_key int, invoice_id string, item_id string, invoice_detail_quantity decimal(20,6),
        invoice_detail_unit_value decimal(20,6), invoice_detail_is_present boolean""",
    "erp_pos_credit_notes": """
        id string, company_key int, branch_id string, register_id string, person_id_seller string,
        credit_note_subtotal decimal(20,6), credit_note_discount decimal(20,6),
        credit_note_date date, credit_note_year int, credit_note_month int, credit_note_day int,
        document_mode string, credit_note_status_dian string, credit_note_state_dian string,
        credit_note_is_closed boolean""",
    "erp_pos_credit_note_details": """
        company_key int, credit_note_id string, item_id string, credit_note_detail_quantity decimal(20,6),
        credit_note_detail_unit_value decimal(20,6), credit_note_detail_is_present boolean""",
    "erp_pos_register_closures": """
        id string, company_key int, register_id string, branch_id string, document_id string,
        document_id_refund string, document_id_advance string, register_closure_consecutive bigint,
        register_closure_date date, register_closure_done boolean, register_closure_exception string,
        register_closure_opening_balance decimal(20,6), register_closure_recount decimal(20,6),
        register_opened_at timestamp_ntz, register_closure_created_at timestamp_ntz,
        register_closure_created_by string, register_closure_updated_at timestamp_ntz,
        register_closure_updated_by string""",
    "erp_pos_expenses": """
        company_key int, branch_id string, register_id string, expense_date_time timestamp_ntz,
        expense_created_at timestamp_ntz, expense_amount decimal(20,6), expense_is_readonly boolean""",
    "erp_pos_advances": "company_key int, register_id string, advance_date date, advance_is_closed boolean",
    "erp_branch": "id string, branch_name string",
    "erp_pos_registers": "id string, register_name string",
    "erp_document": "id string, document_description string",
    "erp_document_detail": "document_id string, document_description string, document_detail_description string",
    "erp_item": """
        id string, company_key int, item_code string, item_name string, item_is_stock boolean, item_has_serial boolean,
        item_fixed_asset_base_depreciation decimal(20,6), item_fixed_asset_depreciation_months int,
        item_fixed_asset_depreciation_monthly decimal(20,6), item_fixed_asset_depreciation_start_date date,
        item_fixed_asset_depreciation_end_date date""",
    "erp_inventory": """
        id string, company_key int, inventory_status string, inventory_type string, inventory_consecutive bigint,
        inventory_description string, inventory_created_at timestamp_ntz, inventory_created_tag string""",
    "erp_inventory_detail": """
        company_key int, inventory_id string, item_id string, item_serial_number string, inventory_detail_type string,
        inventory_detail_quantity decimal(20,6), warehouse_id string, warehouse_id_transfer string,
        inventory_detail_created_at timestamp_ntz""",
    "erp_warehouse": "id string, warehouse_name string",
    "erp_log_fixed_asset": """
        id string, company_key int, item_id string, document_id string, is_done boolean, is_enabled boolean,
        is_disabled boolean, is_revaluation boolean, depreciation_monthly decimal(20,6),
        depreciation_accumulated decimal(20,6), depreciation_date date""",
    "crm_deals": """
        company_key int, deal_name string, amount decimal(20,6), origin_id string, pipeline_id string,
        pipeline_stage_id string, person_id string, item_id string, created_at timestamp_ntz""",
    "crm_origins": "id string, origin_name string",
    "crm_pipelines": "id string, pipeline_name string",
    "crm_pipeline_stages": "id string, pipeline_stage_name string, is_won boolean",
    "common_person": """
        id string, company_key int, person_name string, person_first_name string, person_second_name string,
        identification_type_name string, person_identification string, person_identification_check string,
        person_kind string, person_status_id string, person_state_id string, origin_id string,
        person_created_at timestamp_ntz""",
    "common_person_status": "id string, person_status_name string, person_status_order int",
    "common_person_state": "id string, person_state_name string, person_state_order int",
}


def table_schema(name: str) -> StructType:
    """The declared schema of one table."""
    return StructType.fromDDL(TABLES[name])
