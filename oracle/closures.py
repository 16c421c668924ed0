"""SQL for register closures."""

from oracle.sales import dbl

# Closures with the interval join written as a correlated range condition.
BASE = """
ev AS (
  SELECT event_id AS e, ts, user_id AS u, event_type AS kind, CAST(value AS DECIMAL(18,6)) AS value,
         weekofyear(ts) AS wk
  FROM events
),
clo AS (
  SELECT u, wk, CAST(u AS VARCHAR) || '-' || CAST(wk AS VARCHAR) AS id, MIN(ts) AS opened, MAX(ts) AS closed,
         u * 6 + wk - 1 AS n
  FROM ev GROUP BY u, wk
),
inv AS (
  SELECT c.id AS cid, ev.e, ev.value, CASE ev.kind WHEN 'purchase' THEN 'IN' ELSE 'RF' END AS t
  FROM ev JOIN clo c ON c.u = ev.u AND ev.ts BETWEEN c.opened AND c.closed
  WHERE ev.kind IN ('purchase', 'error')
),
spent AS (
  SELECT c.id AS cid, ev.e, ev.value FROM ev JOIN clo c ON c.u = ev.u AND ev.ts BETWEEN c.opened AND c.closed
  WHERE ev.kind = 'signup'
),
pay AS (
  SELECT cid, t, '"' || e % 3 || '"' AS code, '"Pago ' || e % 3 || '"' AS name, e % 3 < 2 AS cash,
         '"' || (e % 3 + 1105) || '"' AS account, '"Caja"' AS account_name, CAST(value AS DECIMAL(18,2)) AS value,
         '"R' || e || '"' AS ref
  FROM inv
  UNION ALL
  SELECT cid, t, '9', 'null', FALSE, 'null', '"Banco"', CAST(value AS DECIMAL(18,2)), 'null' FROM inv WHERE e % 4 = 0
),
tax AS (
  SELECT cid, t, CAST(e % 2 AS VARCHAR) AS tid, (e // 3) % 3 AS spelling, e % 5 <> 0 AS is_sum,
         CAST(value AS DECIMAL(18,2)) AS base, CAST(value AS DECIMAL(20,2)) * 0.19 AS val
  FROM inv
),
pay_total AS (
  SELECT cid, t, code, MIN(name) AS name, bool_and(cash) AS cash, MIN(account) AS account,
         MIN(account_name) AS account_name, CAST(SUM(value) AS DECIMAL(20,6)) AS value
  FROM pay GROUP BY cid, t, code
),
cash_total AS (SELECT cid, t, code, SUM(value) AS value FROM pay WHERE cash GROUP BY cid, t, code),
tax_total AS (
  SELECT cid, t, tid, MIN(CASE WHEN spelling <> 1 THEN '"IVA"' END) AS name, bool_and(is_sum) AS is_sum,
         CAST(MIN(base) AS DECIMAL(20,6)) AS base, CAST(SUM(base) AS DECIMAL(20,6)) AS sub,
         CAST(SUM(val) AS DECIMAL(20,6)) AS val
  FROM tax GROUP BY cid, t, tid
),
pay_json AS (
  SELECT cid, t, '[' || string_agg(
    '{"paymentTypeCode":' || code || ',"paymentTypeName":' || name || ',"paymentTypeIsCash":' || CAST(cash AS VARCHAR)
    || ',"accountCode_Bankcash":' || account || ',"accountName_Bankcash":' || account_name
    || ',"invoicePaymentValue":' || CAST(value AS VARCHAR) || ',"invoicePaymentReference":null}', ',' ORDER BY code
  ) || ']' AS j
  FROM pay_total GROUP BY cid, t
),
tax_json AS (
  SELECT cid, t, '[' || string_agg(
    '{"taxId":' || tid || ',"taxName":' || coalesce(name, 'null') || ',"taxCategory":"VAT","taxIsSum":'
    || CAST(is_sum AS VARCHAR) || ',"taxPercentValue":19.000000,"taxBase":' || CAST(base AS VARCHAR)
    || ',"taxIsDiscriminate":true,"taxExemptionReason":null,"_SubTotal":' || CAST(sub AS VARCHAR)
    || ',"_ValueTotal":' || CAST(val AS VARCHAR) || '}', ',' ORDER BY tid
  ) || ']' AS j
  FROM tax_total GROUP BY cid, t
)
"""

KEY = "cid AS register_closure_id, t AS invoice_type"


def _ts(column: str, name: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def _taxes(real_names: bool) -> str:
    name = "'\"IVA\"'" if real_names else "CASE WHEN spelling <> 1 THEN '\"IVA\"' END"
    return f"""WITH {BASE}
SELECT {KEY}, tid AS tax_id, {name} AS tax_name, '"VAT"' AS tax_category, CAST(is_sum AS VARCHAR) AS tax_is_sum,
       CAST(19 AS DOUBLE) AS tax_percent_value, {dbl("base", "tax_base")}, 'true' AS tax_is_discriminate,
       CAST(NULL AS VARCHAR) AS tax_exemption_reason, {dbl("base", "sub_total")}, {dbl("val", "value_total")}
FROM tax"""


def _figures(kind: str, suffix: str) -> str:
    """Header figures of one invoice type, one correlated subquery each."""
    of = f"FROM inv WHERE inv.cid = c.id AND inv.t = '{kind}'"
    tax = f"FROM tax WHERE tax.cid = c.id AND tax.t = '{kind}' AND"
    subtotal, discount = "inv.value", "inv.e % 3"
    return f"""
  CAST(coalesce((SELECT MIN(inv.e) {of}), 0) AS BIGINT) AS invoice_consecutive_from{suffix},
  CAST(coalesce((SELECT MAX(inv.e) {of}), 0) AS BIGINT) AS invoice_consecutive_to{suffix},
  CAST((SELECT COUNT(inv.e) {of}) AS BIGINT) AS invoice_quantity{suffix},
  {dbl(f"coalesce((SELECT SUM({subtotal}) {of}), 0)", f"invoice_subtotal{suffix}")},
  {dbl(f"coalesce((SELECT SUM({discount}) {of}), 0)", f"invoice_discount{suffix}")},
  {dbl(f"coalesce((SELECT SUM(tax.val) {tax} tax.is_sum), 0)", f"invoice_tax_sum{suffix}")},
  {dbl(f"coalesce((SELECT SUM(tax.val) {tax} NOT tax.is_sum), 0)", f"invoice_tax_sub{suffix}")},
  {dbl(f"coalesce((SELECT SUM({subtotal} + {discount}) {of}), 0)", f"invoice_total{suffix}")},
  (SELECT j FROM tax_json x WHERE x.cid = c.id AND x.t = '{kind}') AS invoice_taxes{suffix},
  (SELECT j FROM pay_json x WHERE x.cid = c.id AND x.t = '{kind}') AS invoice_payment_types{suffix}"""


def _rebuild(paid: str, refunded: str, joins: str) -> str:
    return f"""WITH {BASE}
SELECT c.id, CAST(c.u % 5 AS BIGINT) AS company_key, CAST(c.u AS VARCHAR) AS register_id,
  CAST(c.u % 25 AS VARCHAR) AS branch_id, CAST(c.n * 3 AS VARCHAR) AS document_id,
  CAST(c.n * 3 + 2 AS VARCHAR) AS document_id_refund, CAST(c.n AS BIGINT) AS register_closure_consecutive,
  CAST(CAST(c.closed AS DATE) AS VARCHAR) AS register_closure_date,
  CAST(c.u % 3 = 0 AS VARCHAR) AS register_closure_done,
  CASE WHEN c.u % 11 = 0 THEN 'Timeout' END AS register_closure_exception,
  {dbl("coalesce((SELECT SUM(value) FROM spent WHERE spent.cid = c.id), 0)", "register_closure_expense_total")},
  CAST(c.u % 100 AS DOUBLE) AS register_closure_opening_balance,
  {dbl(f"coalesce({paid}, 0)", "register_closure_payment")},
  {dbl(f"-coalesce({refunded}, 0)", "register_closure_refund")},
  CAST(c.wk AS DOUBLE) AS register_closure_recount,
  {_figures("IN", "")}, {_figures("RF", "_refund")},
  {_ts("c.opened", "register_opened_at")}, {_ts("c.closed", "register_closure_created_at")},
  CAST(c.u AS VARCHAR) AS register_closure_created_by,
  CAST(NULL AS VARCHAR) AS register_closure_updated_at, CAST(NULL AS VARCHAR) AS register_closure_updated_by
FROM clo c {joins}"""


STATEMENTS = {
    "closure_invoices": f"""WITH {BASE}
SELECT cid AS register_closure_id, CAST(e AS VARCHAR) AS id, t AS invoice_type FROM inv""",
    "closure_expenses": f"""WITH {BASE}
SELECT cid AS register_closure_id, e AS event_id, {dbl("value", "expense_amount")} FROM spent""",
    "closure_payments": f"""WITH {BASE}
SELECT {KEY}, code AS payment_type_code, name AS payment_type_name, CAST(cash AS VARCHAR) AS payment_type_is_cash,
       account AS account_code_bankcash, account_name AS account_name_bankcash,
       {dbl("value", "invoice_payment_value")}, ref AS invoice_payment_reference FROM pay""",
    "closure_payment_totals": f"""WITH {BASE}
SELECT {KEY}, code AS payment_type_code, name AS payment_type_name, CAST(cash AS VARCHAR) AS payment_type_is_cash,
       account AS account_code_bankcash, account_name AS account_name_bankcash,
       {dbl("value", "invoice_payment_value")} FROM pay_total""",
    "closure_payment_references": f"""WITH {BASE}
SELECT {KEY}, code AS payment_type_code, ref AS invoice_payment_reference, COUNT(*) AS occurrences
FROM pay GROUP BY ALL""",
    "closure_reference_lists": f"""WITH {BASE},
placed AS (SELECT *, row_number() OVER (PARTITION BY cid, t, code ORDER BY ref) - 1 AS place FROM pay WHERE ref IS NOT NULL)
SELECT {KEY}, code AS payment_type_code, place // 20 AS piece, COUNT(*) AS size, '[' || string_agg(ref, ',' ORDER BY place) || ']' AS payment_references
FROM placed GROUP BY ALL""",
    "closure_cash_totals": f"""WITH {BASE}
SELECT {KEY}, code AS payment_type_code, {dbl("value", "invoice_payment_value")} FROM cash_total""",
    "closure_payments_json": f"WITH {BASE} SELECT {KEY}, j AS payment_types_json FROM pay_json",
    "closure_taxes": _taxes(real_names=False),
    "closure_taxes_real_names": _taxes(real_names=True),
    "closure_tax_totals": f"""WITH {BASE}
SELECT {KEY}, tid AS tax_id, name AS tax_name, '"VAT"' AS tax_category, CAST(is_sum AS VARCHAR) AS tax_is_sum,
       CAST(19 AS DOUBLE) AS tax_percent_value, {dbl("base", "tax_base")}, 'true' AS tax_is_discriminate,
       CAST(NULL AS VARCHAR) AS tax_exemption_reason, {dbl("sub", "sub_total")}, {dbl("val", "value_total")}
FROM tax_total""",
    "closure_taxes_json": f"WITH {BASE} SELECT {KEY}, j AS taxes_json FROM tax_json",
    "closure_expense_totals": f"""WITH {BASE}
SELECT cid AS register_closure_id, {dbl("SUM(value)", "expense_total")} FROM spent GROUP BY cid""",
    "rebuild_closures": _rebuild(
        "i.value",
        "r.value",
        "LEFT JOIN cash_total i ON i.cid = c.id AND i.t = 'IN' LEFT JOIN cash_total r ON r.cid = c.id AND r.t = 'RF'",
    ),
    "rebuild_closures_one_row": _rebuild(
        "(SELECT SUM(value) FROM pay WHERE pay.cid = c.id AND pay.t = 'IN' AND pay.cash)",
        "(SELECT SUM(value) FROM pay WHERE pay.cid = c.id AND pay.t = 'RF' AND pay.cash)",
        "",
    ),
    "closure_jobs": f"""WITH {BASE}
SELECT 'erp_' || (1001 + u % 5) AS tenant_db, CAST(u % 5 AS BIGINT) AS company_key, id AS entity_id,
       'PosRegisterClosure' AS job_master_type, CAST(1 AS BIGINT) AS job_master_priority,
       'NUEVO' AS job_master_status,
       '  (' || u % 5 || ',''' || id || ''',''PosRegisterClosure'',1,''NUEVO''),' AS values_text
FROM clo WHERE u % 3 <> 0 AND u % 11 <> 0 AND CAST(closed AS DATE) >= DATE '2024-01-15'""",
}
