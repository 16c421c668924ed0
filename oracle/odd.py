"""SQL for the rare cases."""

import uuid

from oracle.closures import BASE
from oracle.misc import CONTACT, DEALS, LINKED, OPTIONS, PERSON_PERIOD, SERIALS, STATEMENTS as _MISC
from oracle.sales import BRANCH, DOCS, ERP, NULL_SELLER, STATEMENTS as _SALES, day, dbl, totals

NO_SELLER = "00000000-0000-0000-0000-000000000000"

# Closures by register: opened a day late, closed three days late, closed years ago (so left out), opened in the year 1.
SHIFTED = f"""{BASE},
shifted AS (
  SELECT id, u, CASE u % 5 WHEN 0 THEN opened + INTERVAL 1 DAY WHEN 4 THEN TIMESTAMP '0001-01-01' ELSE opened END AS opened,
         CASE u % 5 WHEN 1 THEN closed + INTERVAL 3 DAY WHEN 2 THEN closed - INTERVAL 3 YEAR ELSE closed END AS closed
  FROM clo
),
held AS (
  SELECT c.id AS cid, ev.* FROM ev JOIN shifted c ON c.u = ev.u AND ev.ts >= c.opened AND ev.ts <= c.closed
  WHERE c.closed >= TIMESTAMP '2022-06-01'
)"""

# The payload text per event, read with JSON functions: objects of arrays only, the last of a repeated key, the first spelling present.
ODD = f"""{BASE},
payload AS (
  SELECT cid, t, e, CASE e % 12
    WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '[' WHEN 3 THEN '5' WHEN 4 THEN '[1, "x", null]'
    WHEN 5 THEN '{{"paymentTypeCode": "1"}}'
    WHEN 6 THEN '[{{"paymentTypeCode":"1","paymentTypeIsCash":true,"invoicePaymentValue":1,"invoicePaymentValue":7}},{{"paymentTypeCode":"2","invoicePaymentValue":3}}]'
    WHEN 7 THEN '[{{"payment_type_code":"c","PaymentTypeCode":null,"paymentTypeCode":"b","invoice_payment_value":2,"invoicePaymentValue":4}}]'
    WHEN 8 THEN '[{{"payment_type_code":"c","paymentTypeCode":"b","invoice_payment_value":"2.50"}}]'
    WHEN 9 THEN '[]' END AS j
  FROM inv WHERE e % 12 <= 9
),
element AS (
  SELECT cid, t, e, x.id AS place, x.value AS v
  FROM (SELECT * FROM payload WHERE json_valid(j) AND json_type(j) = 'ARRAY') p, json_each(p.j) x
),
pair AS (SELECT cid, t, e, place, k.key AS name, arg_max(k.value, k.rowid) AS v, arg_max(k.type, k.rowid) AS kind
         FROM (SELECT * FROM element WHERE json_type(v) = 'OBJECT') o, json_each(o.v) k GROUP BY ALL),
spelled(name, field, rank) AS (
  VALUES ('PaymentTypeCode', 'code', 0), ('paymentTypeCode', 'code', 1), ('payment_type_code', 'code', 2),
         ('PaymentTypeIsCash', 'cash', 0), ('paymentTypeIsCash', 'cash', 1), ('payment_type_is_cash', 'cash', 2),
         ('InvoicePaymentValue', 'value', 0), ('invoicePaymentValue', 'value', 1), ('invoice_payment_value', 'value', 2)
),
best AS (
  SELECT cid, t, e, place, field, arg_min(v, rank) AS v, arg_min(kind, rank) AS kind FROM pair JOIN spelled USING (name) GROUP BY ALL
),
read AS (
  SELECT o.cid, o.t, o.e, o.place,
         MAX(CASE WHEN field = 'code' THEN CAST(b.v AS VARCHAR) END) AS code,
         coalesce(MAX(CASE WHEN field = 'cash' THEN CAST(b.v AS VARCHAR) END), 'false') = 'true' AS cash,
         coalesce(MAX(CASE WHEN field = 'value' THEN TRY_CAST(trim(CAST(b.v AS VARCHAR), '"') AS DECIMAL(20,6)) END), 0) AS value
  FROM element o LEFT JOIN best b ON (b.cid, b.t, b.e, b.place) = (o.cid, o.t, o.e, o.place) GROUP BY ALL
)"""

TWO = SERIALS.replace(
    "'S' || l.l_suppkey % 10 AS serial", "CASE WHEN l.l_suppkey % 10 <> 3 THEN 'S' || l.l_suppkey % 10 END AS serial, l.l_orderkey % 2 AS company"
).replace("SELECT m.p, m.serial,", "SELECT m.p, m.serial, m.company,")

_GAPS = OPTIONS.replace("SELECT DISTINCT product, band FROM opt", "SELECT DISTINCT product, band FROM opt WHERE product NOT LIKE '%1'")


def _flow() -> str:
    """The listing of company 1, from that of the whole sample."""
    text = _MISC["serial_inventory_flow"].replace(SERIALS, TWO)
    text = text.replace("FROM broken\n  UNION ALL", "FROM broken WHERE company = 1 AND serial IS NOT NULL\n  UNION ALL")
    return text.replace(
        "ON m.p = b.p AND m.serial = b.serial JOIN orders", "ON m.p = b.p AND m.serial = b.serial AND b.company = 1 AND m.company = 1 JOIN orders"
    )


def _short(number: str) -> str:
    """A number without the zeros that end its decimals."""
    return f"CASE WHEN contains({number}, '.') THEN rtrim(rtrim({number}, '0'), '.') ELSE {number} END"


# Both payloads of each invoice, walked down together with json_keys and json_extract; p_whole and t_whole are their texts with sorted names.
_PAYLOADS = f"""
WITH RECURSIVE e AS (SELECT event_id AS n, user_id AS u, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS v FROM events WHERE event_type IN ('purchase', 'error')),
old AS (
  SELECT n, u, '[{{"code":"' || n % 3 || '","amount":' || v || ',"lines":[' || n % 4 || ',[' || n % 5 || ']],"meta":{{"at":{{"k":' || n % 2 || '}},"note":null}}}}' || more || ']' AS payments,
         '[{{"amount":' || {_short("v")} || ',"code":"' || n % 3 || '","lines":[' || n % 4 || ',[' || n % 5 || ']],"meta":{{"at":{{"k":' || n % 2 || '}},"note":null}}}}' || more || ']' AS p_whole,
         CASE WHEN n % 8 <> 0 THEN '{{"rate":' || n % 3 || ',"names":["IVA","' || n % 4 || '"]}}' END AS taxes,
         CASE WHEN n % 8 <> 0 THEN '{{"names":["IVA","' || n % 4 || '"],"rate":' || n % 3 || '}}' END AS t_whole
  FROM (SELECT *, CASE WHEN n % 6 = 0 THEN ',{{"a":"x","b":[]}}' ELSE '' END AS more FROM e) WHERE n % 17 <> 0),
new AS (
  SELECT n, u, '[{{"meta":' || meta || ',"lines":' || lines || ',"amount":' || amount || ',"code":' || code || '}}]' AS payments,
         '[{{"amount":' || {_short("amount")} || ',"code":' || code || ',"lines":' || lines || ',"meta":' || meta || '}}]' AS p_whole,
         CASE WHEN n % 12 = 0 THEN '[1e1]' ELSE '{{"names":' || names || ',"rate":' || n % 3 || '.0}}' END AS taxes,
         CASE WHEN n % 12 = 0 THEN '[10.0]' ELSE '{{"names":' || names || ',"rate":' || n % 3 || '}}' END AS t_whole
  FROM (
    SELECT *, CASE WHEN n % 11 = 0 THEN '{{"at":7,' ELSE '{{"at":{{"k":' || n % 2 || CASE WHEN n % 14 = 0 THEN ',"z.z":[1,{{"a":1}}]' ELSE '' END || '}},' END
           || '"note":' || CASE WHEN n % 7 = 0 THEN '"n"' ELSE 'null' END || '}}' AS meta,
           '[' || n % 4 || CASE WHEN n % 5 > 0 THEN ',[' || (n % 5 + CASE WHEN n % 13 = 0 THEN 1 ELSE 0 END) || ']' ELSE '' END || ']' AS lines,
           v || CASE WHEN n % 10 = 0 THEN '7' ELSE '00' END AS amount,
           CASE WHEN n % 9 = 0 THEN CAST(n % 3 AS VARCHAR) ELSE '"' || n % 3 || '"' END AS code,
           '["IVA","' || n % 4 || '"' || CASE WHEN n % 5 = 0 THEN ',"ICA"' ELSE '' END || ']' AS names FROM e)
  WHERE n % 19 <> 0),
pair AS (
  SELECT coalesce(o.n, w.n) AS n, o.u AS ou, w.u AS wu, o.payments AS op, w.payments AS wp, o.p_whole AS ow, w.p_whole AS ww, o.taxes AS ot, w.taxes AS wt,
         o.t_whole AS otw, w.t_whole AS wtw FROM old o FULL JOIN new w ON o.n = w.n),
node AS (
  SELECT n, 'payments' AS path, op::JSON AS l, wp::JSON AS r, ow AS lw, ww AS rw FROM pair
  UNION ALL SELECT n, 'taxes', ot::JSON, wt::JSON, otw, wtw FROM pair
  UNION ALL
  SELECT n, path || '.' || CASE WHEN contains(step, '.') THEN '`' || step || '`' ELSE step END,
         CASE json_type(l) WHEN 'OBJECT' THEN json_extract(l, '$."' || step || '"') ELSE json_extract(l, '$[' || step || ']') END,
         CASE json_type(r) WHEN 'OBJECT' THEN json_extract(r, '$."' || step || '"') ELSE json_extract(r, '$[' || step || ']') END, NULL, NULL
  FROM (SELECT *, unnest(CASE json_type(l) WHEN 'OBJECT' THEN list_distinct(list_concat(json_keys(l), json_keys(r)))
                         ELSE [CAST(i AS VARCHAR) FOR i IN range(greatest(json_array_length(l), json_array_length(r))::BIGINT)] END) AS step
        FROM node WHERE json_type(l) = json_type(r) AND json_type(l) IN ('OBJECT', 'ARRAY'))),
leaf AS (
  SELECT n, path, json_type(l) IN ('UBIGINT', 'BIGINT', 'DOUBLE') AS ln, json_type(r) IN ('UBIGINT', 'BIGINT', 'DOUBLE') AS rn,
         coalesce(lw, CAST(l AS VARCHAR)) AS l, coalesce(rw, CAST(r AS VARCHAR)) AS r FROM node
  WHERE json_type(l) IS DISTINCT FROM json_type(r) OR json_type(l) NOT IN ('OBJECT', 'ARRAY')),
shown AS (SELECT n, path, CASE WHEN ln THEN {_short("l")} ELSE l END AS l, CASE WHEN rn THEN {_short("r")} ELSE r END AS r FROM leaf)
SELECT CAST(n AS VARCHAR) AS id, path, l AS "left", r AS "right" FROM shown WHERE l IS DISTINCT FROM r
UNION ALL SELECT CAST(n AS VARCHAR), 'user_id', CAST(ou AS VARCHAR), CAST(wu AS VARCHAR) FROM pair WHERE ou IS DISTINCT FROM wu"""


# The invoices of five tenants with the text each column has under its common type.
_DRIFTED = """
WITH e AS (
  SELECT event_id AS n, user_id AS u, user_id % 5 AS k, CAST(value AS DECIMAL(18,2)) AS v, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS moment
  FROM events WHERE event_type IN ('purchase', 'error')),
row_of AS (
  SELECT n, 'erp_' || (1001 + k) AS tenant, k, CAST(n AS VARCHAR) AS id,
         CASE k WHEN 3 THEN 'R' || u WHEN 4 THEN u || '.5' ELSE CAST(u AS VARCHAR) END AS register,
         CASE k WHEN 0 THEN CASE WHEN n % 10 <> 0 THEN v END WHEN 2 THEN trunc(v) WHEN 3 THEN CASE WHEN n % 9 <> 0 THEN v END WHEN 4 THEN trunc(v) ELSE v END AS amount,
         CASE k WHEN 1 THEN moment ELSE substr(moment, 1, 10) END AS opened, CASE k WHEN 2 THEN '[' || n % 3 || ']' WHEN 4 THEN CASE WHEN n % 2 = 0 THEN CAST(n AS VARCHAR) END END AS extra,
         k = 0 AND n % 10 = 0 OR k = 3 AND n % 9 = 0 AS lost, CASE k WHEN 0 THEN CAST(CAST(v AS DOUBLE) + 1e-7 AS VARCHAR) ELSE 'n/a' END AS told FROM e)"""

_STORED_AS = [
    ("id", "string", ("string", "bigint", "string", "string", "string")),
    ("register", "string", ("int", "bigint", "int", "string", "decimal(12,1)")),
    ("amount", "decimal(20,6)", ("double", "decimal(18,2)", "int", "string", "bigint")),
    ("opened", "string", ("date", "timestamp_ntz", "date", "date", "string")),
    ("extra", "string", (None, None, "array<int>", None, "string")),
]


def _type_drift() -> str:
    rows = [f"('{name}', '{common}', {k}, '{kind}')" for name, common, kinds in _STORED_AS for k, kind in enumerate(kinds) if kind]
    return f"""{_DRIFTED}
SELECT r.tenant, s.name, s.stored_type, s.common_type, COUNT(*) FILTER (s.name <> 'extra' OR r.extra IS NOT NULL) AS filled,
       COUNT(*) FILTER (s.name = 'amount' AND r.lost) AS lost
FROM row_of r JOIN (VALUES {", ".join(rows)}) AS s(name, common_type, k, stored_type) ON s.k = r.k GROUP BY ALL"""


def _uuid5(table: str, *key: str) -> str:
    """The id of a row: SHA-1 of the table's namespace and the key's parts with their lengths."""
    namespace = uuid.uuid5(uuid.uuid5(uuid.NAMESPACE_DNS, "ledgerlane"), table).hex
    name = " || ".join(f"coalesce(strlen({part}) || ':' || {part}, '-')" for part in key)
    h = f"sha1(unhex('{namespace}') || encode({name}))"
    variant = f"substr('89ab', (instr('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1)"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


_RAGGED = f"""{OPTIONS},
brand AS (SELECT DISTINCT p_brand AS product, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) % 5 AS kind FROM part),
wrap(pos, v) AS (VALUES (0, 'box'), (1, 'paper'), (2, 'bag')), gift(pos, v) AS (VALUES (0, 'yes'), (1, 'no'))"""


def _together(*parts: str) -> str:
    """Several reports as one table."""
    return "\nUNION ALL BY NAME\n".join(f"SELECT *, '{name}' AS report FROM ({text})" for name, text in zip(("branch", "seller", "item"), parts))


# Invoices whose modes, states and branches are spelled in several ways.
_SPELLED = f"""WITH {DOCS},
spelled AS (
  SELECT d.*, CASE WHEN k % 19 = 0 THEN ['TEST', 'test'][k % 2 + 1] ELSE ['PRODUCTION', 'Prodúction', 'production'][k % 3 + 1] END AS mode,
         CASE WHEN st = 'P' THEN ['ANULADA', 'anuláda', 'Anulada'][k // 2 % 3 + 1] ELSE ['ACTIVA', 'Activa'][k // 2 % 2 + 1] END AS status,
         CASE WHEN k % 17 = 0 THEN NULL WHEN k % 5 = 0 THEN ['Emisión', 'EMISION', 'Emision'][k // 5 % 3 + 1] ELSE 'Ninguno' END AS dian,
         CASE WHEN k % 15 = 0 THEN ['Válida', 'VALIDA', 'Valida'][k // 15 % 3 + 1] END AS state,
         CASE k % 3 WHEN 0 THEN lower(n_name) WHEN 1 THEN translate(n_name, 'AEIOU', 'ÁÉÍÓÚ') ELSE n_name END AS branch_name,
         (subtotal - discount - CASE WHEN ins AND NOT has_refund THEN refund ELSE 0 END) * rate AS net
  FROM doc d JOIN nation ON CAST(n_nationkey AS VARCHAR) = d.branch WHERE residue < 2),
found AS (
  SELECT * FROM spelled WHERE mode COLLATE NOCASE.NOACCENT = 'production' AND status COLLATE NOCASE.NOACCENT <> 'Anulada'
    AND (dian COLLATE NOCASE.NOACCENT <> 'Emision' OR dian COLLATE NOCASE.NOACCENT = 'Emision' AND state COLLATE NOCASE.NOACCENT = 'Valida'))"""


STATEMENTS = {
    "sales_reports_together": _together(*[_SALES[f"sales_by_{grain}"] for grain in ("branch", "seller", "item")]),
    "pos_sales_reports_together": _together(*[_SALES[f"pos_sales_by_{grain}"] for grain in ("branch", "seller", "item")]),
    "sales_by_item_bucketed": _SALES["sales_by_item"],
    "eligible_documents_collated": f"""{_SPELLED}
SELECT CAST(k AS VARCHAR) AS id, CAST(company AS BIGINT) AS company_key, seller AS person_id_seller FROM found""",
    "sales_by_branch_collated": f"""{_SPELLED}
SELECT CAST(company AS BIGINT) AS company_key, MIN(branch_name) AS branch_id, {dbl("SUM(net)", "net_amount")}
FROM found GROUP BY company, strip_accents(lower(branch_name))""",
    "people_of_states_collated": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS person_state_id, lower(c_mktsegment) AS person_state_name FROM customer WHERE c_custkey % 10 <> 3""",
    "option_combinations_ragged": f"""WITH {_RAGGED}
SELECT product, 0 AS ordinal, '' AS combination FROM brand WHERE kind = 0
UNION ALL SELECT product, pos, v FROM bd JOIN brand USING (product) WHERE kind = 1
UNION ALL
SELECT ty.product, (ty.pos * a.ns + sz.pos) * a.nb + bd.pos, ty.v || '|' || sz.v || '|' || bd.v
FROM ty JOIN sz USING (product) JOIN bd USING (product) JOIN amount a USING (product) JOIN brand USING (product) WHERE kind = 2
UNION ALL
SELECT ty.product, (((ty.pos * 3 + w.pos) * a.nb + bd.pos) * 2 + g.pos) * a.ns + sz.pos, concat_ws('|', ty.v, w.v, bd.v, g.v, sz.v)
FROM ty JOIN sz USING (product) JOIN bd USING (product) JOIN amount a USING (product) JOIN brand USING (product), wrap w, gift g WHERE kind = 3""",
    "option_combination_counts_ragged": f"""WITH {_RAGGED}
SELECT product, [0, 1, 3, 5, 2][kind + 1]::BIGINT AS axes, CASE kind WHEN 0 THEN 1 WHEN 1 THEN nb WHEN 2 THEN nt * ns * nb WHEN 3 THEN nt * ns * nb * 6 ELSE 0 END AS combinations
FROM amount JOIN brand USING (product)""",
    "sales_report_ids": f"""WITH {ERP}
SELECT DISTINCT {_uuid5("consolidated_sales_seller", "company::VARCHAR", f"coalesce(seller, '{NO_SELLER}')", "year(d)::VARCHAR", "month(d)::VARCHAR", "day(d)::VARCHAR")} AS id,
       {NULL_SELLER}, {day()} FROM erp""",
    "movement_ids": f"""SELECT {_uuid5("erp_inventory_detail", "company_key::VARCHAR", "inventory_id", "item_id", "item_serial_number")} AS id, * FROM (
  SELECT DISTINCT l_orderkey % 2 AS company_key, CAST(l_orderkey AS VARCHAR) AS inventory_id, CAST(l_partkey AS VARCHAR) AS item_id,
         CASE WHEN l_suppkey % 10 <> 3 THEN 'S' || l_suppkey % 10 END AS item_serial_number FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)""",
    "column_type_drift": _type_drift(),
    "reconciled_invoices": f"""{_DRIFTED}
SELECT tenant AS tenant_db, id, register, CAST(amount AS DOUBLE) AS amount, opened, extra FROM row_of""",
    "reconciled_invoice_losses": f"""{_DRIFTED}
SELECT tenant AS tenant_db, 'amount' AS name, CASE k WHEN 0 THEN 'double' ELSE 'string' END AS stored_type, told AS value, COUNT(*) AS "rows"
FROM row_of WHERE lost GROUP BY ALL""",
    "invoice_payload_differences": _PAYLOADS,
    "replace_sales_report_extra_column": f"""WITH {ERP},
pos AS (SELECT * FROM doc WHERE settled AND (residue = 3 OR pos_status IN ('PD', 'CL'))),
source AS ({totals(BRANCH, "erp", "net", "d >= DATE '1998-06-01'")}),
target AS ({totals(BRANCH, "pos", "subtotal")})
SELECT *, NULL AS note, 'ERP' AS origin FROM source
UNION ALL
SELECT *, 'N' || branch_id, NULL FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE (s.company_key, s.branch_id, s.sales_date) = (t.company_key, t.branch_id, t.sales_date))""",
    "closure_invoices_shifted": f"""WITH {SHIFTED}
SELECT cid AS register_closure_id, CAST(e AS VARCHAR) AS id, CASE kind WHEN 'purchase' THEN 'IN' ELSE 'RF' END AS invoice_type
FROM held WHERE kind IN ('purchase', 'error')""",
    "closure_expenses_shifted": f"""WITH {SHIFTED}
SELECT cid AS register_closure_id, e AS event_id, {dbl("value", "expense_amount")} FROM held WHERE kind = 'signup'""",
    "closure_payments_odd": f"""WITH {ODD}
SELECT cid AS register_closure_id, t AS invoice_type, code AS payment_type_code, CAST(NULL AS VARCHAR) AS payment_type_name,
       CAST(cash AS VARCHAR) AS payment_type_is_cash, CAST(NULL AS VARCHAR) AS account_code_bankcash,
       CAST(NULL AS VARCHAR) AS account_name_bankcash, {dbl("value", "invoice_payment_value")},
       CAST(NULL AS VARCHAR) AS invoice_payment_reference FROM read
UNION ALL
SELECT cid, t, '"' || e % 3 || '"', '"Pago ' || e % 3 || '"', CAST(e % 3 < 2 AS VARCHAR), '"' || (e % 3 + 1105) || '"', '"Caja"',
       {dbl("CAST(value AS DECIMAL(18,2))", "v")}, '"R' || e || '"' FROM inv WHERE e % 12 > 9
UNION ALL
SELECT cid, t, '9', 'null', 'false', 'null', '"Banco"', {dbl("CAST(value AS DECIMAL(18,2))", "v")}, 'null'
FROM inv WHERE e % 12 > 9 AND e % 4 = 0""",
    "closure_payload_rejects": f"""WITH {SHIFTED}
SELECT CAST(e AS VARCHAR) AS id, CAST(u % 5 AS BIGINT) AS company_key,
       concat_ws('|', CASE WHEN e % 12 IN (1, 2) THEN 'invoice_payment_types' END, CASE WHEN e % 25 = 0 THEN 'invoice_taxes' END) AS payloads
FROM held WHERE kind IN ('purchase', 'error') AND (e % 12 IN (1, 2) OR e % 25 = 0)""",
    "closure_jobs_of_tenants": f"""WITH {BASE}
SELECT 'erp_' || (1001 + u % 5) AS tenant_db, CAST(u % 5 AS BIGINT) AS company_key, id AS entity_id,
       'PosRegisterClosure' AS job_master_type, CAST(1 AS BIGINT) AS job_master_priority,
       'NUEVO' AS job_master_status,
       '  (' || u % 5 || ',''' || id || ''',''PosRegisterClosure'',1,''NUEVO''),' AS values_text
FROM clo WHERE u % 3 <> 0 AND u % 11 <> 0 AND CAST(closed AS DATE) >= DATE '2024-01-15' AND u % 5 IN (1, 4)""",
    "broken_serials_of_company": f"""WITH {TWO}
SELECT CAST(company AS BIGINT) AS company_key, CAST(p AS VARCHAR) AS item_id, serial AS item_serial_number,
       code AS item_code, name AS item_name, {dbl("ins", "inventory_incomes")}, {dbl("outs", "inventory_outcomes")},
       {dbl("expected", "expected_stock")} FROM broken WHERE company = 1""",
    "serial_inventory_flow_of_company": _flow(),
    "serial_flow_rejects": f"""WITH {TWO}
SELECT CAST(company AS BIGINT) AS company_key, CAST(p AS VARCHAR) AS item_id, serial AS item_serial_number,
       code AS item_code, name AS item_name, {dbl("ins", "inventory_incomes")}, {dbl("outs", "inventory_outcomes")},
       {dbl("expected", "expected_stock")} FROM broken WHERE serial IS NULL""",
    "depreciation_rejects_linked": """
SELECT CAST(0 AS BIGINT) AS company_key, CAST(p_partkey AS VARCHAR) AS item_id,
       'ERROR: Ya hay depreciaciones contabilizadas' AS message
FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 13 = 0""",
    "new_contacts_of_company": f"""WITH {DEALS}
SELECT d.name AS "Nombre", {CONTACT} AS "Contacto", i.p_name AS "Plan", {dbl("d.amount", '"Valor negocio"')},
       g.n_name AS "Origen", d.stage AS "Etapa", strftime(d.created, '%Y-%m-%d %H:%M:%S.%f') AS "Creado"
FROM customer c JOIN nation g ON g.n_nationkey = c.c_nationkey LEFT JOIN deal d ON d.person = c.c_custkey
LEFT JOIN part i ON i.p_partkey = d.plan
WHERE g.n_regionkey = 1 AND {PERSON_PERIOD}""",
    "closure_descriptions_of_register": f"""WITH {BASE}, {LINKED}, mine AS (
  SELECT t.* FROM touched t WHERE k IN (SELECT c.n * 3 + s FROM clo c, range(0, 3) r(s) WHERE c.u = 7)
)
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, coalesce(t.description, o.o_orderpriority) AS document_description
FROM orders o LEFT JOIN mine t ON t.k = o.o_orderkey""",
    "column_drift_stored": """
WITH seen AS (
  SELECT DISTINCT 'erp_' || (1001 + user_id % 5) AS tenant, name FROM events
  CROSS JOIN (VALUES ('id'), ('person_id_seller'), ('loyalty_code')) AS c(name)
  WHERE event_type IN ('purchase', 'error') AND (name <> 'person_id_seller' OR user_id % 5 <> 3) AND (name <> 'loyalty_code' OR user_id % 5 = 1)
)
SELECT t.tenant AS missing_in, n.name, CAST(n.present AS BIGINT) AS present_tenants
FROM (SELECT DISTINCT tenant FROM seen) t CROSS JOIN (SELECT name, COUNT(*) AS present FROM seen GROUP BY name) n
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.tenant = t.tenant AND s.name = n.name)""",
    "find_people_by_list": """
SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(n_regionkey AS BIGINT) AS company_key,
       CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS person_name,
       CASE WHEN c_custkey % 10 <> 3 THEN c_mktsegment END AS person_state_id
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey IN (1, 8, 15, 22, 29, 36, 43, 50, 57)""",
    "option_combination_counts_gaps": f"""WITH {_GAPS}
SELECT product, nt AS size_0, ns AS size_1, nb AS size_2, nt * ns * nb AS combinations FROM amount""",
    "option_combinations_gaps": f"""WITH {_GAPS}
SELECT ty.product, (ty.pos * a.ns + sz.pos) * a.nb + bd.pos AS ordinal, ty.v || '|' || sz.v || '|' || bd.v AS combination
FROM ty JOIN sz ON sz.product = ty.product JOIN bd ON bd.product = ty.product JOIN amount a ON a.product = ty.product""",
    "customer_differences_restructured": """
WITH pair AS (
  SELECT c_custkey AS k, CAST(CAST(c_acctbal AS DECIMAL(20,6)) AS VARCHAR) AS old_balance,
         CAST(CAST(c_acctbal + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS DECIMAL(20,6)) AS VARCHAR) AS new_balance,
         c_mktsegment AS old_segment, CASE WHEN c_custkey % 15 <> 0 THEN c_mktsegment END AS new_segment,
         CASE WHEN c_custkey % 4 = 0 THEN 'x' || c_custkey END AS extra, CAST(c_nationkey AS VARCHAR) AS nation
  FROM customer
), entry AS (
  SELECT k, 'profile.balance' AS path, old_balance AS l, new_balance AS r FROM pair UNION ALL
  SELECT k, 'profile.extra', NULL, extra FROM pair UNION ALL
  SELECT k, 'facts.`seg.ment`', old_segment, new_segment FROM pair UNION ALL
  SELECT k, 'gone', CAST(k % 7 AS VARCHAR), NULL FROM pair UNION ALL
  SELECT k, 'added', NULL, CAST(k % 3 AS VARCHAR) FROM pair
)
SELECT k AS c_custkey, path, l AS "left", r AS "right" FROM entry WHERE l IS DISTINCT FROM r
UNION ALL SELECT k, 'c_nationkey', nation, nation FROM pair""",
}
for _name in ("closure_invoices_by_blocks", "closure_invoices_by_days"):
    STATEMENTS[_name] = STATEMENTS["closure_invoices_shifted"]
