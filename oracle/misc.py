"""SQL for serial stock, fixed assets, CRM, corrections, tenants, combinations and differences."""

from oracle.closures import BASE
from oracle.sales import dbl

SERIALS = """
mv AS (
  SELECT l.l_partkey AS p, 'S' || l.l_suppkey % 10 AS serial, l.l_returnflag AS f, l.l_orderkey AS k,
         CAST(l.l_quantity AS DECIMAL(20,6)) AS q, s.s_nationkey AS w, l.l_linenumber AS ln, l.l_shipdate AS moved
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
),
stock AS (
  SELECT m.p, m.serial, 'P' || m.p AS code, i.p_name AS name, SUM(CASE WHEN f = 'R' THEN q ELSE 0 END) AS ins,
         SUM(CASE WHEN f = 'N' THEN q ELSE 0 END) AS outs, SUM(CASE WHEN f = 'R' THEN q ELSE -q END) AS expected
  FROM mv m JOIN part i ON i.p_partkey = m.p JOIN orders o ON o.o_orderkey = m.k
  WHERE i.p_size <= 45 AND i.p_type <> 'ECONOMY' AND o.o_orderstatus <> 'P' GROUP BY ALL
),
broken AS (SELECT * FROM stock WHERE ins < outs OR (expected <> 0 AND outs >= 1 AND ins - 1 > outs))
"""

# Month by month, the date carried from one instalment to the next. The instalment is rounded half up in whole cents.
SCHEDULE = """
asset AS (
  SELECT p_partkey AS p, CAST(p_retailprice AS DECIMAL(20,6)) AS base, p_size AS n,
         CAST(CAST((2 * CAST(round(p_retailprice * 100) AS BIGINT) + p_size) // (2 * p_size) AS DECIMAL(18,0))
              * 0.01 AS DECIMAL(20,6)) AS monthly
  FROM part WHERE p_size >= 1
),
step AS (
  SELECT p, base, n, monthly, 1 AS i, monthly AS reached, CAST(DATE '2024-01-31' + INTERVAL 1 MONTH AS DATE) AS d
  FROM asset
  UNION ALL
  SELECT p, base, n, monthly, i + 1, CAST(reached + monthly AS DECIMAL(20,6)), CAST(d + INTERVAL 1 MONTH AS DATE)
  FROM step WHERE i < n
),
schedule AS (
  SELECT p, CASE WHEN i = n AND reached > base THEN monthly + (base - reached) ELSE monthly END AS monthly,
         CASE WHEN i = n AND reached > base THEN base ELSE reached END AS accumulated, d
  FROM step
)
"""

CONTACT = """
CASE WHEN c.c_custkey IS NULL THEN '' ELSE concat_ws(' ',
  coalesce(CASE WHEN c.c_custkey % 4 <> 0 THEN c.c_name END,
    concat_ws(' ', 'F' || c.c_custkey, CASE WHEN c.c_custkey % 3 <> 0 THEN 'S' || c.c_custkey END,
      'F' || c.c_custkey, 'F' || c.c_custkey)),
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'NIT' ELSE 'CC' END,
  concat_ws('-', CAST(c.c_custkey AS VARCHAR), CASE WHEN c.c_custkey % 6 <> 0 THEN CAST(c.c_custkey % 10 AS VARCHAR) END))
END
"""

DEALS = """
deal AS (
  SELECT o.o_orderkey AS k, 'Negocio ' || o.o_orderkey AS name, CAST(o.o_totalprice AS DECIMAL(18,6)) AS amount,
         own.c_nationkey AS origin, r.r_name || ': Etapa ' || o.o_orderstatus AS stage, o.o_orderstatus AS st,
         CASE WHEN o.o_orderkey % 9 <> 0 THEN o.o_custkey END AS person,
         CASE WHEN o.o_orderkey % 8 <> 0 THEN o.o_orderkey % 2000 END AS plan, o.o_orderdate AS created
  FROM orders o JOIN customer own ON own.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = own.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
)
"""

PERSON_PERIOD = """
DATE '1997-06-01' + CAST(c.c_custkey % 730 AS INTEGER) BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31 23:59:59'
"""

LINKED = f"""
linked AS (
  SELECT c.n * 3 + s.step AS k,
         'Cierre de caja #' || c.n || ' ' || b.n_name || ' > Caja ' || c.u || ' - ' || s.word AS description
  FROM clo c JOIN nation b ON b.n_nationkey = c.u % 25
  CROSS JOIN (VALUES (0, 'Ventas'), (1, 'Anticipos'), (2, 'Devoluciones')) AS s(step, word)
),
touched AS (
  SELECT k, description FROM linked WHERE k IN (SELECT o_orderkey FROM orders) AND k IN (SELECT l_orderkey FROM lineitem)
)
"""

DRIFT = """
tenant AS (
  SELECT 'erp_' || (1001 + user_id % 5) AS tenant, user_id, event_id,
         CASE WHEN (event_id // 3) % 3 = 2 AND user_id % 5 = 4 THEN 1 ELSE (event_id // 3) % 3 END AS spelling
  FROM events WHERE event_type IN ('purchase', 'error')
),
spelled(spelling, name) AS (
  VALUES (0, 'PaymentTypeCode'), (0, 'PaymentTypeName'), (0, 'PaymentTypeIsCash'), (0, 'AccountCode_Bankcash'),
         (0, 'AccountName_Bankcash'), (0, 'InvoicePaymentValue'), (0, 'InvoicePaymentReference'),
         (1, 'paymentTypeCode'), (1, 'paymentTypeName'), (1, 'paymentTypeIsCash'), (1, 'accountCode_Bankcash'),
         (1, 'accountName_Bankcash'), (1, 'invoicePaymentValue'), (1, 'invoicePaymentReference'),
         (2, 'payment_type_code'), (2, 'payment_type_name'), (2, 'payment_type_is_cash'), (2, 'account_code_bankcash'),
         (2, 'account_name_bankcash'), (2, 'invoice_payment_value'), (2, 'invoice_payment_reference')
),
seen_key AS (SELECT DISTINCT tenant, name FROM tenant JOIN spelled USING (spelling)),
seen_column AS (
  SELECT DISTINCT tenant, name FROM tenant
  CROSS JOIN (VALUES ('id'), ('register_id'), ('person_id_seller'), ('invoice_status'), ('invoice_payment_types')) AS c(name)
  WHERE name <> 'person_id_seller' OR user_id % 5 <> 3
)
"""


def _lacking(seen: str) -> str:
    return f"""WITH {DRIFT}
SELECT t.tenant AS missing_in, n.name, CAST(n.present AS BIGINT) AS present_tenants
FROM (SELECT DISTINCT tenant FROM tenant) t CROSS JOIN (SELECT name, COUNT(*) AS present FROM {seen} GROUP BY name) n
WHERE NOT EXISTS (SELECT 1 FROM {seen} s WHERE s.tenant = t.tenant AND s.name = n.name)"""


def _between(seen: str, present: str, missing: str) -> str:
    return f"""WITH {DRIFT}
SELECT '{present}' AS present_in, '{missing}' AS missing_in, name
FROM (SELECT name FROM {seen} WHERE tenant = '{present}' EXCEPT SELECT name FROM {seen} WHERE tenant = '{missing}')"""


def _reopened(kind: str, key: str, flag: str) -> str:
    return f"""
SELECT {key}, CAST(user_id AS VARCHAR) AS register_id,
       CAST(event_id % 2 = 0 AND NOT (user_id = 7 AND CAST(ts AS DATE) >= DATE '2024-01-15') AS VARCHAR) AS {flag}
FROM events WHERE event_type = '{kind}'"""


# Whole seconds of 2024-01-15 onwards; register 7 belongs to company 7 % 5 = 2.
_REOPENED_ROWS = "user_id = 7 AND event_id % 2 = 0 AND CAST(ts AS DATE) >= DATE '2024-01-15'"

OPTIONS = """
opt AS (
  SELECT DISTINCT p_brand AS product, p_type AS ty, lpad(CAST(p_size AS VARCHAR), 2, '0') AS sz,
         CAST(CAST(floor(p_retailprice / 500) AS INTEGER) AS VARCHAR) AS band
  FROM part
),
ty AS (SELECT product, ty AS v, row_number() OVER (PARTITION BY product ORDER BY ty) - 1 AS pos FROM (SELECT DISTINCT product, ty FROM opt)),
sz AS (SELECT product, sz AS v, row_number() OVER (PARTITION BY product ORDER BY sz) - 1 AS pos FROM (SELECT DISTINCT product, sz FROM opt)),
bd AS (SELECT product, band AS v, row_number() OVER (PARTITION BY product ORDER BY band) - 1 AS pos FROM (SELECT DISTINCT product, band FROM opt)),
amount AS (
  SELECT product, (SELECT COUNT(*) FROM ty WHERE ty.product = o.product) AS nt,
         (SELECT COUNT(*) FROM sz WHERE sz.product = o.product) AS ns,
         (SELECT COUNT(*) FROM bd WHERE bd.product = o.product) AS nb
  FROM (SELECT DISTINCT product FROM opt) o
)
"""

SNAPSHOTS = """
old AS (
  SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS nation, CAST(c_acctbal AS DECIMAL(12,2)) AS balance,
         c_mktsegment AS segment
  FROM customer WHERE c_custkey % 50 <> 2
),
new AS (
  SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS nation,
         CAST(c_acctbal AS DECIMAL(12,2)) + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS balance,
         CASE WHEN c_custkey % 15 <> 0 THEN c_mktsegment END AS segment
  FROM customer WHERE c_custkey % 50 <> 1
),
pair AS (
  SELECT coalesce(o.c_custkey, n.c_custkey) AS k, o.c_custkey IS NULL AS added, n.c_custkey IS NULL AS removed,
         o.c_name AS name_o, n.c_name AS name_n, o.nation AS nation_o, n.nation AS nation_n,
         CAST(o.balance AS VARCHAR) AS bal_o, CAST(n.balance AS VARCHAR) AS bal_n, o.segment AS seg_o, n.segment AS seg_n
  FROM old o FULL OUTER JOIN new n ON o.c_custkey = n.c_custkey
)
"""


def _json_text(column: str) -> str:
    return f"coalesce('\"' || {column} || '\"', 'null')"


def _nested(side: str) -> dict[str, str]:
    """JSON text of the nested columns on one side."""
    name, nation, balance, segment = (f"{c}_{side}" for c in ("name", "nation", "bal", "seg"))
    return {
        "profile": f"""'{{"name":' || {_json_text(name)} || ',"account":{{"balance":' || {balance} || '}}}}'""",
        "facts": f"""'{{"segment":' || {_json_text(segment)} || ',"nation":"' || {nation} || '"}}'""",
        "tags": f"""'[' || {_json_text(segment)} || ',"' || {nation} || '"]'""",
    }


def _nested_whole() -> str:
    left, right = _nested("o"), _nested("n")
    return " UNION ALL ".join(
        f"""SELECT k AS c_custkey, '{column}' AS path, CASE WHEN NOT added THEN {left[column]} END AS "left",
       CASE WHEN NOT removed THEN {right[column]} END AS "right" FROM pair WHERE added OR removed"""
        for column in ("profile", "facts", "tags")
    )


STATEMENTS = {
    "broken_serials": f"""WITH {SERIALS}
SELECT CAST(0 AS BIGINT) AS company_key, CAST(p AS VARCHAR) AS item_id, serial AS item_serial_number,
       code AS item_code, name AS item_name, {dbl("ins", "inventory_incomes")}, {dbl("outs", "inventory_outcomes")},
       {dbl("expected", "expected_stock")} FROM broken""",
    "serial_inventory_flow": f"""WITH {SERIALS}, flow AS (
  SELECT expected, code, serial, CAST(p AS VARCHAR) AS item, 0 AS lvl, CAST(NULL AS TIMESTAMP) AS moved, '' AS c1, code AS c2, name AS c3,
         serial AS c4, CAST(CAST(ins AS DECIMAL(20,6)) AS VARCHAR) AS c5,
         CAST(CAST(outs AS DECIMAL(20,6)) AS VARCHAR) AS c6,
         CAST(CAST(expected AS DECIMAL(20,6)) AS VARCHAR) AS c7,
         CAST(NULL AS VARCHAR) AS c8, CAST(NULL AS VARCHAR) AS c9
  FROM broken
  UNION ALL
  SELECT b.expected, b.code, b.serial, CAST(b.p AS VARCHAR), 1, m.moved, o.o_orderpriority,
         concat_ws(' -> ', f.n_name, CASE WHEN m.ln % 2 <> 0 THEN t.n_name END),
         CASE WHEN m.f = 'R' THEN 'Entrada' ELSE 'Salida' END,
         CAST(CASE WHEN m.f = 'R' THEN m.q ELSE -m.q END AS VARCHAR), strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S'),
         CASE WHEN o.o_custkey % 3 <> 0 THEN 'T' || o.o_custkey ELSE '' END, '',
         'Movimiento de inventario # ' || o.o_orderkey, 'Orden de ' || o.o_custkey
  FROM broken b JOIN mv m ON m.p = b.p AND m.serial = b.serial JOIN orders o ON o.o_orderkey = m.k
  JOIN nation f ON f.n_nationkey = m.w JOIN nation t ON t.n_nationkey = (m.w + 1) % 25
)
SELECT row_number() OVER (ORDER BY expected, code, serial, item, lvl, moved NULLS FIRST, c8 NULLS FIRST, c3, c4, c2, c5) AS "#",
       c1 AS "Tipo", c2 AS "Cód producto", c3 AS "Nombre producto", c4 AS "Serial", c5 AS "Entradas", c6 AS "Salidas",
       c7 AS "Stock", c8 AS "Movimiento de inventario", c9 AS "Descripción"
FROM flow""",
    "depreciation_schedule": f"""WITH RECURSIVE {SCHEDULE}
SELECT CAST(0 AS BIGINT) AS company_key, CAST(p AS VARCHAR) AS item_id, 'true' AS is_enabled, 'false' AS is_disabled,
       'false' AS is_revaluation, {dbl("monthly", "depreciation_monthly")},
       {dbl("accumulated", "depreciation_accumulated")}, CAST(d AS VARCHAR) AS depreciation_date FROM schedule""",
    "depreciation_log": f"""WITH RECURSIVE {SCHEDULE}, old_log AS (
  SELECT p_partkey AS p, s AS step, CASE WHEN s = 1 THEN p_partkey % 7 = 0 WHEN p_partkey % 11 <> 0 THEN FALSE END AS done
  FROM part CROSS JOIN (VALUES (1), (2)) AS v(s)
)
SELECT 'L' || p || '-' || step AS id, CAST(0 AS BIGINT) AS company_key, CAST(p AS VARCHAR) AS item_id,
       CAST(done AS VARCHAR) AS is_done, 'true' AS is_enabled, 'false' AS is_disabled, 'false' AS is_revaluation,
       CAST(step AS DOUBLE) AS depreciation_monthly, CAST(step * 2 AS DOUBLE) AS depreciation_accumulated,
       '2023-12-31' AS depreciation_date
FROM old_log WHERE p % 7 = 0 OR done IS NULL
UNION ALL
SELECT '', 0, CAST(p AS VARCHAR), NULL, 'true', 'false', 'false', {dbl("monthly", "m")}, {dbl("accumulated", "a")},
       CAST(d AS VARCHAR)
FROM schedule WHERE p % 7 <> 0""",
    "depreciation_rejects": """
SELECT CAST(0 AS BIGINT) AS company_key, CAST(p_partkey AS VARCHAR) AS item_id,
       'ERROR: Ya hay depreciaciones contabilizadas' AS message
FROM part WHERE p_partkey % 7 = 0""",
    "won_deals": f"""WITH {DEALS}
SELECT d.name AS "Nombre", {CONTACT} AS "Contacto", i.p_name AS "Plan", {dbl("d.amount", '"Valor negocio"')},
       g.n_name AS "Origen", d.stage AS "Etapa", strftime(d.created, '%Y-%m-%d %H:%M:%S.%f') AS "Creado"
FROM deal d JOIN nation g ON g.n_nationkey = d.origin LEFT JOIN customer c ON c.c_custkey = d.person
LEFT JOIN part i ON i.p_partkey = d.plan
WHERE d.st = 'F' AND d.created BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31 23:59:59'""",
    "new_contacts": f"""WITH {DEALS}
SELECT d.name AS "Nombre", {CONTACT} AS "Contacto", i.p_name AS "Plan", {dbl("d.amount", '"Valor negocio"')},
       g.n_name AS "Origen", d.stage AS "Etapa", strftime(d.created, '%Y-%m-%d %H:%M:%S.%f') AS "Creado"
FROM customer c JOIN nation g ON g.n_nationkey = c.c_nationkey LEFT JOIN deal d ON d.person = c.c_custkey
LEFT JOIN part i ON i.p_partkey = d.plan
WHERE {PERSON_PERIOD}""",
    "leads_with_origin": f"""
SELECT concat_ws(' ', CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'NIT' ELSE 'CC' END,
         concat_ws('-', CAST(c.c_custkey AS VARCHAR),
           CASE WHEN c.c_custkey % 6 <> 0 THEN CAST(c.c_custkey % 10 AS VARCHAR) END)) AS "Identificación",
       CASE WHEN c.c_custkey % 4 <> 0 THEN c.c_name END AS "Razón social (nombre)", n.n_name AS "Origen",
       CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'Empresa' ELSE 'Contacto' END AS "Tipo", r.r_name AS "Etapa",
       lower(c.c_mktsegment) AS "Estado"
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = c.c_nationkey % 5
WHERE c.c_custkey % 10 <> 3 AND {PERSON_PERIOD}""",
    "closure_document_descriptions": f"""WITH {BASE}, {LINKED}
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, coalesce(t.description, o.o_orderpriority) AS document_description
FROM orders o LEFT JOIN touched t ON t.k = o.o_orderkey""",
    "closure_detail_descriptions": f"""WITH {BASE}, {LINKED}
SELECT CAST(l.l_orderkey AS VARCHAR) AS document_id, coalesce(t.description, l.l_returnflag) AS document_description,
       CASE WHEN t.k IS NULL THEN l.l_linestatus END AS document_detail_description
FROM lineitem l LEFT JOIN touched t ON t.k = l.l_orderkey""",
    "reopened_invoices": """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS register_id,
       CASE WHEN event_id % 2 = 0 AND NOT (user_id = 7 AND CAST(ts AS DATE) >= DATE '2024-01-15')
            THEN 'CL' ELSE 'PD' END AS invoice_status
FROM events WHERE event_type IN ('purchase', 'error')""",
    "reopened_credit_notes": _reopened("error", "CAST(event_id AS VARCHAR) AS id", "credit_note_is_closed"),
    "reopened_advances": _reopened("view", "event_id", "advance_is_closed"),
    "reopened_expenses": _reopened("signup", "event_id", "expense_is_readonly"),
    "reopened_counts": f"""
SELECT v.name AS table_name, COUNT(e.event_id) AS changed
FROM (VALUES ('erp_pos_invoice', 'purchase'), ('erp_pos_invoice', 'error'), ('erp_pos_credit_notes', 'error'),
             ('erp_pos_advances', 'view'), ('erp_pos_expenses', 'signup')) AS v(name, kind)
LEFT JOIN (SELECT * FROM events WHERE {_REOPENED_ROWS}) e ON e.event_type = v.kind
GROUP BY v.name""",
    "column_drift": _lacking("seen_column"),
    "column_drift_between": _between("seen_column", "erp_1001", "erp_1004"),
    "payload_key_drift": _lacking("seen_key"),
    "payload_key_drift_between": _between("seen_key", "erp_1002", "erp_1005"),
    "find_people_by_id": """
SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(n_regionkey AS BIGINT) AS company_key,
       CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS person_name,
       CASE WHEN c_custkey % 10 <> 3 THEN c_mktsegment END AS person_state_id
FROM customer JOIN nation ON n_nationkey = c_nationkey
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""",
    "option_combination_counts": f"""WITH {OPTIONS}
SELECT product, nt AS size_0, ns AS size_1, nb AS size_2, nt * ns * nb AS combinations FROM amount""",
    "option_combinations": f"""WITH {OPTIONS}
SELECT ty.product, (ty.pos * a.ns + sz.pos) * a.nb + bd.pos AS ordinal, ty.v || '|' || sz.v || '|' || bd.v AS combination
FROM ty JOIN sz ON sz.product = ty.product JOIN bd ON bd.product = ty.product JOIN amount a ON a.product = ty.product""",
    "customer_differences": f"""WITH {SNAPSHOTS}, entry AS (
  SELECT k, 'c_name' AS path, name_o AS l, name_n AS r FROM pair UNION ALL
  SELECT k, 'c_nationkey', nation_o, nation_n FROM pair UNION ALL
  SELECT k, 'c_acctbal', bal_o, bal_n FROM pair UNION ALL
  SELECT k, 'c_mktsegment', seg_o, seg_n FROM pair
)
SELECT k AS c_custkey, path, l AS "left", r AS "right" FROM entry WHERE l IS DISTINCT FROM r""",
    "customer_differences_nested": f"""WITH {SNAPSHOTS}, leaf AS (
  SELECT k, 'profile.account.balance' AS path, bal_o AS l, bal_n AS r FROM pair WHERE NOT added AND NOT removed UNION ALL
  SELECT k, 'facts.segment', seg_o, seg_n FROM pair WHERE NOT added AND NOT removed UNION ALL
  SELECT k, 'tags.0', seg_o, seg_n FROM pair WHERE NOT added AND NOT removed
)
SELECT k AS c_custkey, path, l AS "left", r AS "right" FROM leaf WHERE l IS DISTINCT FROM r
UNION ALL {_nested_whole()}""",
}
STATEMENTS["customer_differences_by_hash"] = STATEMENTS["customer_differences_nested"]
