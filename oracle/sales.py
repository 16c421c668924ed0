"""SQL for document eligibility, amounts and consolidated sales."""

DOCS = """
doc AS (
  SELECT o.o_orderkey AS k, n.n_regionkey AS company, CAST(c.c_nationkey AS VARCHAR) AS branch,
         CASE WHEN o.o_custkey % 50 = 0 THEN NULL ELSE CAST(o.o_custkey % 50 AS VARCHAR) END AS seller,
         o.o_orderpriority = '1-URGENT' AS ins, o.o_orderkey % 2 = 0 AS has_refund,
         o.o_orderkey % 7 + o.o_orderkey % 3 AS refund,
         CASE o.o_orderkey % 10 WHEN 1 THEN 3.5 ELSE 1 END AS rate,
         CAST(o.o_totalprice AS DECIMAL(18,6)) AS subtotal, o.o_orderkey % 100 AS discount,
         CAST(o.o_orderdate AS DATE) AS d, o.o_orderkey % 4 AS residue, o.o_orderstatus AS st,
         CASE WHEN o.o_orderkey % 13 = 0 THEN 'OP' WHEN o.o_orderkey % 4 = 2 THEN 'Parked'
              WHEN o.o_orderkey % 4 = 0 THEN 'PD' ELSE 'CL' END AS pos_status,
         o.o_orderkey % 19 <> 0 AND o.o_orderkey % 17 <> 0
           AND (o.o_orderkey % 5 <> 0 OR o.o_orderkey % 15 = 0) AS settled
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
)
"""

# Eligible documents with their net amount; side 1 = sale, -1 = refund.
ERP = (
    DOCS
    + """, erp AS (
  SELECT *, CASE residue WHEN 2 THEN 'debit_note' WHEN 3 THEN 'credit_note' ELSE 'invoice' END AS kind,
         (subtotal - discount - CASE WHEN residue < 2 AND ins AND NOT has_refund THEN refund ELSE 0 END) * rate AS net
  FROM doc WHERE settled AND st <> 'P'
)
"""
)

POS = (
    DOCS
    + """, pos AS (
  SELECT *, CASE WHEN residue = 3 THEN 'pos_credit_note' ELSE 'pos_invoice' END AS kind
  FROM doc WHERE settled AND (residue = 3 OR pos_status IN ('PD', 'CL'))
)
"""
)

LINES = """, line AS (
  SELECT l_orderkey AS k, CAST(l_partkey AS VARCHAR) AS item, CAST(l_quantity AS DECIMAL(19,6)) AS qty,
         CAST(l_extendedprice AS DECIMAL(19,6)) AS unit, l_linenumber AS qty_refund,
         l_returnflag = 'A' AND l_linenumber = 7 AS gift, CAST(l_shipdate AS DATE) AS ship
  FROM lineitem
)
"""

ERP_LINES = """, erp_line AS (
  SELECT e.company, e.branch, l.item, l.ship AS d, e.residue, e.d AS doc_date,
         (l.qty - CASE WHEN e.residue < 2 AND e.ins AND NOT e.has_refund THEN l.qty_refund ELSE 0 END)
           * l.unit * e.rate AS net
  FROM line l JOIN erp e ON e.k = l.k WHERE NOT l.gift
)
"""


def dbl(expression: str, name: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(28,6)) AS DOUBLE) AS {name}"


def day(column: str = "d") -> str:
    return (
        f"CAST(year({column}) AS BIGINT) AS sales_year, CAST(month({column}) AS BIGINT) AS sales_month, "
        f"CAST(day({column}) AS BIGINT) AS sales_day"
    )


def totals(keys: str, source: str, amount: str, where: str = "TRUE") -> str:
    return f"""
SELECT {keys}, {day()},
       {dbl(f"SUM(CASE WHEN residue <> 3 THEN {amount} ELSE 0 END)", "sales_total")},
       {dbl(f"SUM(CASE WHEN residue = 3 THEN {amount} ELSE 0 END)", "sales_total_refund")},
       CAST(MIN(d) AS VARCHAR) AS sales_date
FROM {source} WHERE {where} GROUP BY ALL
"""


COMPANY = "CAST(company AS BIGINT) AS company_key"
BRANCH = f"{COMPANY}, branch AS branch_id"
ITEM = f"{BRANCH}, item AS item_id"
SELLER = f"{COMPANY}, seller AS person_id_seller"
NULL_SELLER = f"{COMPANY}, coalesce(seller, '00000000-0000-0000-0000-000000000000') AS person_id_seller"
Y_AND_M = "year({0}) >= 1998 AND month({0}) >= 6"

_ELIGIBLE = f"""
SELECT kind, CAST(k AS VARCHAR) AS id, {BRANCH}, seller AS person_id_seller, CAST(d AS VARCHAR) AS document_date
FROM {{0}} WHERE {{1}}
"""

_POS_LINES = """, pos_line AS (
  SELECT p.company, p.branch, l.item, p.d, p.residue, l.qty * l.unit AS net
  FROM line l JOIN pos p ON p.k = l.k WHERE NOT l.gift
)
"""

_MONTH = (
    DOCS
    + """, m AS (
  SELECT * FROM doc
  WHERE company = 1 AND year(d) = 1998 AND month(d) = 6 AND (residue = 3 OR pos_status IN ('PD', 'CL'))
)
"""
)

STATEMENTS = {
    "eligible_documents": f"WITH {ERP} " + _ELIGIBLE.format("erp", "TRUE"),
    "eligible_documents_year_and_month": f"WITH {ERP} "
    + _ELIGIBLE.format("erp", f"company = 2 AND {Y_AND_M.format('d')}"),
    "eligible_documents_since": f"WITH {ERP} " + _ELIGIBLE.format("erp", "d >= DATE '1998-06-01'"),
    "eligible_pos_documents": f"WITH {POS} " + _ELIGIBLE.format("pos", Y_AND_M.format("d")),
    "net_header_amounts": f"WITH {ERP} SELECT kind, CAST(k AS VARCHAR) AS id, {dbl('net', 'net_amount')} FROM erp",
    "net_detail_amounts": f"""WITH {ERP} {LINES} {ERP_LINES}
SELECT {ITEM}, {dbl("CASE WHEN residue <> 3 THEN net ELSE 0 END", "sales_total")},
       {dbl("CASE WHEN residue = 3 THEN net ELSE 0 END", "sales_total_refund")},
       CAST(d AS VARCHAR) AS sales_date, {day()} FROM erp_line""",
    "sales_by_branch": f"WITH {ERP} " + totals(BRANCH, "erp", "net"),
    "sales_by_branch_from": f"WITH {ERP} "
    + totals(BRANCH, "erp", "net", f"company = 1 AND {Y_AND_M.format('d')}"),
    "sales_by_seller": f"WITH {ERP} " + totals(NULL_SELLER, "erp", "net"),
    "sales_by_item": f"WITH {ERP} {LINES} {ERP_LINES} " + totals(ITEM, "erp_line", "net"),
    "sales_by_item_from": f"WITH {ERP} {LINES} {ERP_LINES} "
    + totals(ITEM, "erp_line", "net", f"{Y_AND_M.format('d')} AND {Y_AND_M.format('doc_date')}"),
    "pos_sales_by_branch": f"WITH {POS} " + totals(BRANCH, "pos", "subtotal"),
    "pos_sales_by_seller": f"WITH {POS} " + totals(SELLER, "pos", "subtotal", "seller IS NOT NULL"),
    "pos_sales_by_item": f"WITH {POS} {LINES} {_POS_LINES} " + totals(ITEM, "pos_line", "net"),
    "pos_month_by_branch": f"WITH {_MONTH} " + totals(BRANCH, "m", "subtotal"),
    "pos_month_by_seller": f"WITH {_MONTH} " + totals(SELLER, "m", "subtotal", "seller IS NOT NULL"),
    "pos_month_by_item": f"""WITH {_MONTH} {LINES}, ml AS (
  SELECT m.company, m.branch, l.item, m.d, m.residue, l.qty * l.unit AS net FROM line l JOIN m ON m.k = l.k
) """
    + totals(ITEM, "ml", "net"),
    "replace_sales_report": f"""WITH {ERP},
pos AS (SELECT * FROM doc WHERE settled AND (residue = 3 OR pos_status IN ('PD', 'CL'))),
source AS ({totals(BRANCH, "erp", "net", "d >= DATE '1998-06-01'")}),
target AS ({totals(BRANCH, "pos", "subtotal")})
SELECT * FROM source
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE (s.company_key, s.branch_id, s.sales_date) = (t.company_key, t.branch_id, t.sales_date))""",
}
