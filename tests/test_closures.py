from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal as D

import pytest

from ledgerlane.plans import closures as c
from ledgerlane.plans.job_queue import closure_jobs

OPEN, CLOSE, LATER = datetime(2023, 1, 1, 8), datetime(2023, 1, 2, 20), datetime(2023, 1, 3, 20)


def closure(id="c1", opened=OPEN, closed=CLOSE, **values):
    return {
        "id": id,
        "company_key": 1,
        "branch_id": "b",
        "register_id": "r",
        "register_opened_at": opened,
        "register_closure_created_at": closed,
        **values,
    }


def invoice(id="i1", at=datetime(2023, 1, 1, 9), kind="IN", payments="[]", taxes="[]", **values):
    return {
        "id": id,
        "company_key": 1,
        "branch_id": "b",
        "register_id": "r",
        "invoice_type": kind,
        "invoice_created_at": at,
        "invoice_payment_types": payments,
        "invoice_taxes": taxes,
        **values,
    }


def payment(code="1", value=10, cash=True, **more):
    return {"paymentTypeCode": code, "invoicePaymentValue": value, "paymentTypeIsCash": cash, **more}


@pytest.fixture
def attached(make):
    def build(*invoices):
        spans = c.closure_spans(make("erp_pos_register_closures", closure()))
        return c.attach_invoices(spans, make("erp_pos_invoice", *invoices))

    return build


def test_boundary_invoice_belongs_to_both_closures(make):
    closures = make(
        "erp_pos_register_closures",
        closure(),
        closure("c2", CLOSE, LATER),
        closure("reversed", LATER, OPEN),
        closure("open", None, LATER),
        closure("elsewhere", register_id="other"),
    )
    invoices = make(
        "erp_pos_invoice",
        invoice("first", OPEN),
        invoice("boundary", CLOSE),
        invoice("last", LATER),
        invoice("before", datetime(2023, 1, 1, 7, 59, 59)),
        invoice("after", datetime(2023, 1, 4)),
        invoice("unknown", None),
    )
    pairs = sorted((r.register_closure_id, r.id) for r in c.attach_invoices(c.closure_spans(closures), invoices).collect())
    assert pairs == [("c1", "boundary"), ("c1", "first"), ("c2", "boundary"), ("c2", "last")]


def test_old_closures_are_left_out(make):
    closures = make("erp_pos_register_closures", closure(), closure("old", closed=datetime(2022, 5, 31, 23)))
    assert [row.id for row in c.recent_closures(closures).collect()] == ["c1"]


def test_three_spellings(attached):
    rows = [
        {"PaymentTypeCode": "p", "AccountCode_Bankcash": 1, "InvoicePaymentValue": 1.5},
        {"paymentTypeCode": "c", "accountCode_Bankcash": 2, "invoicePaymentValue": "2.25"},
        {"payment_type_code": "s", "account_code_bankcash": 3, "invoice_payment_value": 3},
        {},
        5,
    ]
    found = c.explode_payments(attached(invoice(payments=json.dumps(rows)))).collect()
    shown = sorted(
        (row.payment_type_code or "", row.account_code_bankcash or "", row.invoice_payment_value) for row in found
    )
    assert shown == [
        ("", "", D(0)),
        ("", "", D(0)),
        ('"c"', "2", D("2.25")),
        ('"p"', "1", D("1.5")),
        ('"s"', "3", D(3)),
    ]


def test_present_null_wins_over_later_spelling(attached):
    rows = '[{"PaymentTypeCode": null, "paymentTypeCode": "1", "InvoicePaymentValue": null, "invoicePaymentValue": 7}]'
    found = c.explode_payments(attached(invoice(payments=rows))).first()
    assert (found.payment_type_code, found.invoice_payment_value) == ("null", 0)


@pytest.mark.parametrize(("value", "expected"), [("true", True), ('"true"', False), ("1", False), ("null", False)])
def test_only_json_true_is_cash(attached, value, expected):
    found = c.explode_payments(attached(invoice(payments=f'[{{"payment_type_is_cash": {value}}}]'))).first()
    assert found.payment_type_is_cash is expected


def test_text_and_number_codes_stay_apart(attached):
    rows = [payment("1", 1), payment(1, 2), payment("1", 4)]
    totals = c.payment_totals(c.explode_payments(attached(invoice(payments=json.dumps(rows)))))
    assert {row.payment_type_code: row.invoice_payment_value for row in totals.collect()} == {'"1"': 5, "1": 2}


@pytest.mark.parametrize("payload", ["[]", None, "[oops", '{"a": 1}'])
def test_payloads_without_elements_give_no_rows(attached, payload):
    invoices = attached(invoice(payments=payload, taxes=payload))
    assert c.explode_payments(invoices).count() == 0
    assert c.explode_taxes(invoices).count() == 0


def test_malformed_payloads_are_reported(make):
    invoices = make("erp_pos_invoice", invoice(), invoice("bad", payments="[oops"), invoice("none", payments=None))
    assert [(row.id, row.payloads) for row in c.payload_rejects(invoices).collect()] == [
        ("bad", ["invoice_payment_types"])
    ]


def test_tax_name_is_read_under_the_misspelt_keys(attached):
    invoices = attached(invoice(taxes='[{"taxName": "real"}, {"taxNametaxName": "odd", "TaxName": "real"}]'))
    assert sorted(str(row.tax_name) for row in c.explode_taxes(invoices).collect()) == ['"odd"', "None"]
    real = c.explode_taxes(invoices, real_tax_names=True)
    assert sorted(row.tax_name for row in real.collect()) == ['"odd"', '"real"']


def test_missing_tax_id_is_its_own_group(attached):
    taxes = [{"taxId": 1, "valueTotal": 1}, {"valueTotal": 2}, {"_ValueTotal": 4, "valueTotal": 9}]
    totals = c.tax_totals(c.explode_taxes(attached(invoice(taxes=json.dumps(taxes)))))
    assert {row.tax_id: row.value_total for row in totals.collect()} == {"1": 1, None: 6}


@pytest.fixture
def rebuilt(make):
    def build(*invoices, expenses=(), **options):
        tables = {
            "erp_pos_register_closures": make("erp_pos_register_closures", closure(), closure("empty", register_id="z")),
            "erp_pos_invoice": make("erp_pos_invoice", *invoices),
            "erp_pos_expenses": make("erp_pos_expenses", *expenses),
        }
        rows = c.rebuild_closures(tables, **options)[0].collect()
        return {key: [row for row in rows if row.id == key] for key in ("c1", "empty")}

    return build


CASH = [
    invoice(
        payments=json.dumps([payment("1", 10), payment("2", 5), payment("3", 7, cash=False), payment("1", 1)]),
        taxes=json.dumps([{"taxId": 1, "taxIsSum": True, "valueTotal": 3}, {"taxId": 1, "valueTotal": 4}]),
        invoice_consecutive=8,
        invoice_subtotal=D(100),
        invoice_discount=D(1),
        invoice_total=D(99),
    ),
    invoice("i2", invoice_consecutive=5, invoice_subtotal=D(1)),
    invoice("i3", kind="RF", payments=json.dumps([payment("1", 2), payment("2", 4)]), invoice_consecutive=9),
]


def test_cash_rows_per_payment_code(rebuilt):
    rows = rebuilt(*CASH)["c1"]
    pairs = sorted((row.register_closure_payment, row.register_closure_refund) for row in rows)
    assert pairs == [(5, -4), (5, -2), (11, -4), (11, -2)]


def test_one_row_per_closure_and_its_figures(rebuilt):
    expense = {
        "company_key": 1, "branch_id": "b", "register_id": "r", "expense_date_time": CLOSE, "expense_amount": D("2.5"),
    }
    (row,) = rebuilt(*CASH, expenses=[expense, expense], cash_grain="closure")["c1"]
    assert (row.register_closure_payment, row.register_closure_refund) == (16, -6)
    assert row.register_closure_expense_total == 5
    assert (row.invoice_consecutive_from, row.invoice_consecutive_to, row.invoice_quantity) == (5, 8, 2)
    assert (row.invoice_subtotal, row.invoice_discount, row.invoice_total) == (101, 1, 99)
    assert (row.invoice_tax_sum, row.invoice_tax_sub) == (3, 4)
    assert (row.invoice_consecutive_from_refund, row.invoice_quantity_refund, row.invoice_subtotal_refund) == (9, 1, 0)
    payments = json.loads(row.invoice_payment_types)
    assert [(p["paymentTypeCode"], p["invoicePaymentValue"]) for p in payments] == [("1", 11), ("2", 5), ("3", 7)]
    assert all(p["invoicePaymentReference"] is None for p in payments)
    (tax,) = json.loads(row.invoice_taxes)
    assert (tax["taxId"], tax["taxIsSum"], tax["_ValueTotal"], tax["taxName"]) == (1, False, 7, None)
    assert row.invoice_taxes_refund is None


@pytest.mark.parametrize("grain", ["payment_type", "closure"])
def test_closure_without_invoices_has_zeros(rebuilt, grain):
    (row,) = rebuilt(*CASH, cash_grain=grain)["empty"]
    zeros = ("register_closure_payment", "register_closure_refund", "register_closure_expense_total",
             "invoice_quantity", "invoice_total", "invoice_tax_sum", "invoice_consecutive_from_refund")
    assert [row[name] for name in zeros] == [0] * len(zeros)
    assert row.invoice_payment_types is None


def test_totals_equal_the_exploded_rows(attached):
    payments = c.explode_payments(attached(*CASH))
    total = sum(row.invoice_payment_value for row in c.payment_totals(payments).collect())
    assert total == sum(row.invoice_payment_value for row in payments.collect()) == 29


def test_cash_and_tax_parts_of_the_totals(attached):
    invoices = attached(*CASH)
    payments = c.explode_payments(invoices)
    cash = {(r.invoice_type, r.payment_type_code): r.cash_total for r in c.payment_totals(payments).collect()}
    separate = {(r.invoice_type, r.payment_type_code): r.invoice_payment_value for r in c.cash_totals(payments).collect()}
    assert {key: value for key, value in cash.items() if value is not None} == separate
    assert cash["IN", '"3"'] is None
    (tax,) = c.tax_totals(c.explode_taxes(invoices)).collect()
    assert (tax.tax_sum, tax.tax_sub, tax.value_total) == (3, 4, 7)


def test_references_are_kept_as_rows(attached):
    rows = [payment(invoicePaymentReference="x"), payment(invoicePaymentReference="x"), payment()]
    found = c.payment_references(c.explode_payments(attached(invoice(payments=json.dumps(rows))))).collect()
    assert [(row.invoice_payment_reference, row.occurrences) for row in found] == [('"x"', 2)]


def test_queue_rows(make):
    from pyspark.sql import functions as F

    on = date(2022, 12, 1)
    frame = make(
        "erp_pos_register_closures",
        closure("wait", register_closure_done=False, register_closure_date=on),
        closure("done", register_closure_done=True, register_closure_date=on),
        closure("unknown", register_closure_date=on),
        closure("failed", register_closure_done=False, register_closure_exception="x", register_closure_date=on),
        closure("old", register_closure_done=False, register_closure_date=date(2022, 11, 30)),
    ).withColumn("tenant_db", F.lit("erp_1001"))
    (row,) = closure_jobs(frame).collect()
    assert row.values_text == "  (1,'wait','PosRegisterClosure',1,'NUEVO'),"
    assert (row.entity_id, row.job_master_priority, row.job_master_status) == ("wait", 1, "NUEVO")
    assert closure_jobs(frame, tenants=["erp_1002"]).count() == 0
