from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest

from ledgerlane.plans import pos_month, sales

ERP = {
    "invoice": ("erp_invoice", "invoice"),
    "debit_note": ("erp_invoice_debit_note", "invoice_debit_note"),
    "credit_note": ("erp_invoice_credit_note", "invoice_credit_note"),
}


def erp(kind="invoice", on=date(2023, 7, 5), state="Activa", dian="Ninguno", accepted=None, **values):
    prefix = ERP[kind][1]
    return {
        "id": "d1",
        "company_key": 1,
        "branch_id": "b",
        "document_mode": "production",
        f"{prefix}_status": state,
        f"{prefix}_status_dian": dian,
        f"{prefix}_state_dian": accepted,
        "biz_document_date": on,
        "biz_document_year": on.year,
        "biz_document_month": on.month,
        "biz_document_day": on.day,
        "biz_document_subtotal": D(100),
        "biz_document_discount": D(10),
        "biz_document_exchange_rate": D(1),
        **values,
    }


def detail(document="d1", on=date(2023, 7, 5), gift=False, **values):
    return {
        "company_key": 1,
        "biz_document_id": document,
        "item_id": "i",
        "biz_document_detail_is_present": gift,
        "biz_document_detail_quantity": D(3),
        "biz_document_detail_unit_value": D("2.5"),
        "biz_document_detail_date": on,
        "biz_document_detail_year": on.year,
        "biz_document_detail_month": on.month,
        "biz_document_detail_day": on.day,
        **values,
    }


@pytest.fixture
def tables(make):
    def build(invoices=(), debits=(), credits=(), details=()):
        return {
            "erp_invoice": make("erp_invoice", *invoices),
            "erp_invoice_debit_note": make("erp_invoice_debit_note", *debits),
            "erp_invoice_credit_note": make("erp_invoice_credit_note", *credits),
            "erp_invoice_detail": make("erp_invoice_detail", *details),
            "erp_invoice_debit_note_detail": make("erp_invoice_debit_note_detail"),
            "erp_invoice_credit_note_detail": make("erp_invoice_credit_note_detail"),
        }

    return build


def ids(df):
    return sorted(row.id for row in df.collect())


def test_date_filter_compares_year_and_month_apart(make):
    documents = make(
        "erp_invoice",
        erp(id="jan-later-year", on=date(2024, 1, 9)),
        erp(id="aug-later-year", on=date(2024, 8, 9)),
        erp(id="first-of-month", on=date(2023, 6, 1)),
        erp(id="earlier", on=date(2023, 5, 31)),
    )
    start = date(2023, 6, 15)
    assert ids(sales.eligible_documents(documents, "invoice", date_from=start)) == ["aug-later-year", "first-of-month"]
    since = sales.eligible_documents(documents, "invoice", date_from=start, date_filter="since")
    assert ids(since) == ["aug-later-year", "jan-later-year"]
    with pytest.raises(ValueError):
        sales.eligible_documents(documents, "invoice", date_from=start, date_filter="other")


def test_null_states_drop_the_document(make):
    documents = make(
        "erp_invoice",
        erp(id="plain"),
        erp(id="accepted", dian="Emision", accepted="Valida"),
        erp(id="pending", dian="Emision"),
        erp(id="null-dian", dian=None),
        erp(id="null-status", state=None),
        erp(id="voided", state="Anulada"),
        erp(id="test", document_mode="test"),
        erp(id="other-company", company_key=2),
    )
    assert ids(sales.eligible_documents(documents, "invoice", company_key=1)) == ["accepted", "plain"]


@pytest.mark.parametrize("rate", [None, D(0), D(1)])
def test_missing_rate_counts_as_one(tables, rate):
    result = sales.sales_by_branch(tables([erp(biz_document_exchange_rate=rate)])).first()
    assert result.sales_total == 90


@pytest.mark.parametrize(
    ("type_code", "has_refund", "expected"),
    [("INS", False, 83), ("INS", None, 83), ("INS", True, 90), ("FV", False, 90), (None, False, 90)],
)
def test_refund_reduces_refundable_invoices_only(tables, type_code, has_refund, expected):
    invoice = erp(
        biz_document_type_code=type_code,
        biz_document_has_refund=has_refund,
        biz_document_refund_ingress=D(5),
        biz_document_refund_discount=D(2),
    )
    assert sales.sales_by_branch(tables([invoice])).first().sales_total == expected


def test_products_keep_their_decimals(tables):
    invoice = erp(biz_document_exchange_rate=D("3.123457"), biz_document_subtotal=D("10.123456"))
    lines = [detail(biz_document_detail_quantity=D("1.000001"), biz_document_detail_unit_value=D("1.000001"))]
    result = sales.sales_by_branch(tables([invoice])).first()
    assert result.sales_total == (D("0.123456") * D("3.123457")).quantize(D("1e-8"))
    by_item = sales.sales_by_item(tables([invoice], details=lines)).first()
    assert by_item.sales_total == (D("1.000001") ** 2 * D("3.123457")).quantize(D("1e-8"))


def test_notes_go_to_their_side(tables):
    result = sales.sales_by_branch(
        tables([erp()], [erp("debit_note", biz_document_subtotal=D(50))], [erp("credit_note", biz_document_subtotal=D(40))])
    ).collect()
    assert [(row.sales_total, row.sales_total_refund) for row in result] == [(130, 30)]
    assert result[0].sales_date == date(2023, 7, 5)


def test_documents_of_the_no_seller_replace_those_without(tables):
    rows = [erp(id="a"), erp(id="b", person_id_seller=sales.NO_SELLER, biz_document_subtotal=D(11))]
    result = sales.sales_by_seller(tables(rows)).collect()
    assert [(row.person_id_seller, row.sales_total) for row in result] == [(sales.NO_SELLER, 1)]
    only_missing = sales.sales_by_seller(tables(rows[:1])).collect()
    assert [(row.person_id_seller, row.sales_total) for row in only_missing] == [(sales.NO_SELLER, 90)]


def test_branch_and_seller_reports_agree(tables):
    frames = tables([erp(id=str(i), branch_id=str(i % 3), person_id_seller=str(i % 4)) for i in range(20)])
    by_branch = sum(row.sales_total for row in sales.sales_by_branch(frames).collect())
    by_seller = sum(row.sales_total for row in sales.sales_by_seller(frames).collect())
    assert by_branch == by_seller == 20 * 90


def test_item_lines_use_their_own_date_and_skip_gifts(tables):
    frames = tables(
        [erp()],
        details=[
            detail(),
            detail(gift=True),
            detail(gift=None),
            detail(on=date(2023, 5, 1)),
            detail(document="unknown"),
        ],
    )
    result = sales.sales_by_item(frames, date_from=date(2023, 6, 1)).collect()
    assert [(row.item_id, row.sales_total, row.sales_month) for row in result] == [("i", D("7.5"), 7)]
    assert len(sales.sales_by_item(frames).collect()) == 2


def test_item_refund_quantity_and_discount(tables):
    invoice = erp(biz_document_has_refund=False, biz_document_exchange_rate=D(2))
    line = detail(biz_document_type_code="INS", biz_document_detail_quantity_refund=D(1))
    assert sales.sales_by_item(tables([invoice], details=[line])).first().sales_total == 10


def pos(**values):
    return {
        "id": "p1",
        "company_key": 1,
        "branch_id": "b",
        "invoice_type": "IN",
        "invoice_status": "CL",
        "document_mode": "production",
        "invoice_status_dian": "Ninguno",
        "invoice_subtotal": D(20),
        "invoice_discount": D(5),
        "invoice_date": date(2022, 1, 3),
        "invoice_year": 2022,
        "invoice_month": 1,
        "invoice_day": 3,
        **values,
    }


@pytest.fixture
def pos_tables(make):
    def build(invoices=(), details=()):
        return {
            "erp_pos_invoice": make("erp_pos_invoice", *invoices),
            "erp_pos_credit_notes": make("erp_pos_credit_notes"),
            "erp_pos_invoice_detail": make("erp_pos_invoice_detail", *details),
            "erp_pos_credit_note_details": make("erp_pos_credit_note_details"),
        }

    return build


def test_pos_subtotal_without_discount_and_open_sales_left_out(pos_tables):
    frames = pos_tables(
        [
            pos(),
            pos(id="open", invoice_status="OP"),
            pos(id="parked", invoice_status="Parked"),
            pos(id="unknown", invoice_status=None),
            pos(id="refund", invoice_type="RF"),
        ]
    )
    assert [row.sales_total for row in sales.pos_sales_by_branch(frames).collect()] == [20]
    assert sales.pos_sales_by_seller(frames).count() == 0


def test_pos_month_rules(pos_tables):
    line = {"company_key": 1, "invoice_id": "p1", "item_id": "i", "invoice_detail_quantity": D(2)}
    frames = pos_tables(
        [pos(document_mode="test", invoice_status_dian=None), pos(id="feb", invoice_month=2), pos(id="open", invoice_status="OP")],
        [line, {**line, "invoice_detail_unit_value": D(4), "invoice_detail_is_present": True}],
    )
    reports = pos_month.pos_month_rebuild(frames, 1, 2022, 1)
    assert [row.sales_total for row in reports["branch"].collect()] == [20]
    assert reports["seller"].count() == 0
    assert [row.sales_total for row in reports["item"].collect()] == [8]
    reports["staging"].unpersist()


def test_report_rows_get_distinct_ids(tables):
    frames = tables([erp(id=str(i), branch_id=str(i)) for i in range(5)])
    rows = sales.with_row_ids(sales.sales_by_branch(frames), "report", sales.BRANCH_KEY).collect()
    assert len({row.id for row in rows}) == 5
