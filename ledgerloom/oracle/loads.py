"""Expected results of the load side, stated on the flat tables."""

from .star import money, star

TEXT_NULL = "CAST(NULL AS VARCHAR)"
YEAR = "year(txn_date)"

ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"

LINE_COLUMNS = f"""client_id, {{key}}, CAST(l_linenumber AS VARCHAR) AS line_id,
  p_name AS description, {money('amount')} AS amount"""

EXPENSE = f"""
  CASE WHEN l_linenumber % 2 = 0 THEN 'ItemBasedExpenseLineDetail'
    ELSE 'AccountBasedExpenseLineDetail' END AS detail_type,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey AS VARCHAR) END AS item_id,
  CASE WHEN l_linenumber % 2 = 0 THEN p_name END AS item_name,
  CASE WHEN l_linenumber % 2 = 1 THEN 'EXP-' || p_type END AS account_id,
  CASE WHEN l_linenumber % 2 = 1 THEN p_type END AS account_name,
  'NotBillable' AS billable_status, CAST(o_custkey AS VARCHAR) AS customer_id,
  'TAX' AS tax_code_ref"""

SALES = f"""CAST(l_linenumber AS BIGINT) AS line_num, CAST(l_quantity AS DOUBLE) AS quantity,
  {money('unit_price')} AS unit_price, CAST(l_partkey AS VARCHAR) AS item_id,
  p_name AS item_name, 'INC-' || p_type AS account_id, p_type AS account_name,
  'TAX' AS tax_code_ref, 'SalesItemLineDetail' AS detail_type"""

REPORT = """
, cells AS (SELECT client_id, n_name, c_mktsegment, o_orderstatus, count(*) AS n,
    sum(total) AS total FROM ord JOIN (SELECT c_custkey, c_mktsegment, n_name FROM cust)
    ON o_custkey = c_custkey WHERE {where} GROUP BY ALL),
placed AS (SELECT *,
    lpad(CAST(dense_rank() OVER (PARTITION BY client_id ORDER BY n_name) - 1 AS VARCHAR), 9, '0')
      AS p1,
    lpad(CAST(dense_rank() OVER (PARTITION BY client_id, n_name ORDER BY c_mktsegment) - 1
      AS VARCHAR), 9, '0') AS p2,
    lpad(CAST(dense_rank() OVER (PARTITION BY client_id, n_name, c_mktsegment
      ORDER BY o_orderstatus) - 1 AS VARCHAR), 9, '0') AS p3
  FROM cells),
rep AS (
  SELECT client_id, c_mktsegment AS section, 'Data' AS row_type,
    p1 || '.' || p2 || '.' || p3 AS row_ord, o_orderstatus AS "Status",
    CAST(n AS VARCHAR) AS "Invoices", CAST(total AS VARCHAR) AS "Total" FROM placed
  UNION ALL
  SELECT client_id, c_mktsegment, 'Summary', p1 || '.' || p2 || '.~', 'Total ' || c_mktsegment,
    CAST(sum(n) AS VARCHAR), CAST(sum(total) AS VARCHAR) FROM placed
    GROUP BY client_id, n_name, c_mktsegment, p1, p2
  UNION ALL
  SELECT client_id, n_name, 'Summary', p1 || '.~', 'Total ' || n_name,
    CAST(sum(n) AS VARCHAR), CAST(sum(total) AS VARCHAR) FROM placed
    GROUP BY client_id, n_name, p1)
"""
ALL_YEARS = REPORT.format(where="TRUE")
REPORT_COLUMNS = 'section, row_type, "Status", "Invoices", "Total"'


BACKFILLED = "profitandloss profitandlosscash balancesheet cashflow agedreceivables agedpayables"


def one_year(year: int) -> str:
    """A year's rows, the same for each of the six backfilled reports."""
    return star(REPORT.format(where=f"year(order_date) = {year}") + f"""
SELECT client_id, 'report_' || name AS report_table, CAST({year} AS BIGINT) AS report_year,
  {REPORT_COLUMNS} FROM rep, (SELECT unnest(string_split('{BACKFILLED}', ' ')) AS name)""")


GENERIC = (
    "dim_class dim_department dim_tax_code dim_tax_rate dim_term dim_payment_method "
    "dim_company_info fact_bill_payment fact_deposit fact_credit_memo fact_refund_receipt "
    "fact_sales_receipt fact_journal_entry fact_transfer")


def messy(name: str, *cases: str, kind: str) -> str:
    picks = " ".join(f"WHEN {i} THEN {case}" for i, case in enumerate(cases))
    return f"""SELECT o_orderkey, CAST(CASE o_orderkey % {len(cases)} {picks} END AS {kind})
  AS {name} FROM orders"""


def typed_columns(table: str, source: str = "", **columns: str) -> str:
    """Filled cells and sums of columns given as numbers."""
    return "\n  UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, count({expr}) AS filled, CAST(sum({expr}) AS DOUBLE) AS total "
        f"FROM {source or table}" for name, expr in columns.items())


def _day(date: str) -> str:
    return f"CAST(strftime({date}, '%Y%m%d') AS INTEGER)"


DATES = {"txn_date": _day("txn_date"), "due_date": _day("due_date"), "txn_date_key": _day("txn_date"), "due_date_key": _day("due_date")}
DATED = {k: DATES[k] for k in ("txn_date", "txn_date_key")}
TYPED = "\nUNION ALL ".join([
    typed_columns("dim_date", "calendar", date_key=_day("d"), full_date=_day("d"), day_of_week="CAST(strftime(d, '%w') AS INTEGER)",
                  day_of_month="day(d)", month_num="month(d)", quarter_num="quarter(d)", year_num="year(d)",
                  is_weekend="CAST(dayofweek(d) IN (0, 6) AS INTEGER)"),
    typed_columns("dim_account", current_balance="current_balance", is_active="1", is_sub_account="CAST(parent_account_id IS NOT NULL AS INTEGER)"),
    typed_columns("dim_customer", balance="balance", is_active="1"), typed_columns("dim_vendor", balance="balance", is_active="1"),
    typed_columns("dim_item", unit_price="unit_price", purchase_cost="CAST(NULL AS DOUBLE)", is_active="1"),
    typed_columns("fact_invoice", **DATES, total_amount="total_amount", balance="balance", total_tax="total_tax"),
    typed_columns("fact_invoice_line", line_num="line_num", amount="amount", quantity="quantity",
                  unit_price="CAST(unit_price AS DECIMAL(18,2))", service_date=_day("service_date")),
    typed_columns("fact_payment", **DATED, total_amount="total_amount", unapplied_amount="0"),
    typed_columns("fact_bill", **DATES, total_amount="total_amount", balance="balance"),
    typed_columns("fact_bill_line", line_num="CAST(line_id AS INTEGER)", amount="amount"),
    typed_columns("fact_purchase", **DATED, total_amount="total_amount", is_credit="CAST(is_credit AS INTEGER)"),
    typed_columns("fact_estimate", **DATED, total_amount="total_amount"),
])

LOADS = {
    "raw_entity_scan": star(f"""
SELECT client_id, 'Invoice' AS source_name, invoice_id AS id, {money('total_amount')} AS total
FROM fact_invoice"""),
    "raw_quarantine": star(f"""
SELECT client_id, count(*) FILTER (WHERE CAST(invoice_id AS BIGINT) % 13 <> 0) AS valid,
  count(*) FILTER (WHERE CAST(invoice_id AS BIGINT) % 13 = 0) AS damaged,
  {money('sum(total_amount) FILTER (WHERE CAST(invoice_id AS BIGINT) % 13 <> 0)')} AS valid_total
FROM fact_invoice GROUP BY 1"""),
    "raw_object_scan": star("""
SELECT client_id, customer_id AS id, display_name AS name, display_name AS fully_qualified_name,
  TRUE AS is_active FROM dim_customer WHERE CAST(customer_id AS BIGINT) % 10 <> 0"""),
    "report_scan": """
SELECT r_name AS client_id, s AS source_name, r AS report, CAST(y AS BIGINT) AS report_year,
  p AS endpoint, 'report_' || lower(r) AS report_table, r AS report_name, a AS start_period,
  b AS end_period, CAST(3 AS BIGINT) AS titles, m AS accounting_method
FROM region CROSS JOIN (VALUES
  ('report_AgedReceivables', 'AgedReceivables', NULL, '/reports/AgedReceivables',
   '1995-01-01', '2001-08-01', NULL),
  ('report_ProfitAndLossCash_1998', 'ProfitAndLossCash', 1998, '/reports/ProfitAndLoss',
   '1998-01-01', '1998-12-31', 'Cash'),
  ('backfill_report_CashFlow_1999', 'CashFlow', 1999, '/reports/CashFlow',
   '1999-01-01', '1999-12-31', NULL)) v(s, r, y, p, a, b, m)""",
    "raw_archive_roundtrip": star(f"""
SELECT client_id, 'Invoice' AS source_name, count(*) AS records, {money('sum(total_amount)')}
  AS total FROM fact_invoice GROUP BY 1
UNION ALL
SELECT client_id, 'Payment', count(*), {money('sum(total_amount)')} FROM fact_payment GROUP BY 1"""),
    "typed_scan_invoice": star(f"""
SELECT client_id, invoice_id, doc_number, txn_date, due_date, customer_id,
  {money('total_amount')} AS total_amount, {money('balance')} AS balance,
  {money('total_tax')} AS total_tax, CAST(txn_date_key AS BIGINT) AS txn_date_key,
  CAST(due_date_key AS BIGINT) AS due_date_key FROM fact_invoice"""),
    "typed_scan_tables": star(f"""
, calendar AS (SELECT CAST(unnest(generate_series(a, b + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders))
{TYPED}"""),
    "dim_client": """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS client_name, 'pending' AS qbo_realm_id,
  c_mktsegment AS industry, DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS onboarded_date,
  CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 3 <> 0 ELSE TRUE END AS is_active FROM customer""",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date,
  CAST(strftime(d, '%w') AS BIGINT) AS day_of_week, dayname(d) AS day_name,
  day(d) AS day_of_month, dayofyear(d) AS day_of_year,
  CAST(strftime(d, '%W') AS BIGINT) AS week_of_year, month(d) AS month_num,
  monthname(d) AS month_name, substr(monthname(d), 1, 3) AS month_short,
  quarter(d) AS quarter_num, 'Q' || quarter(d) AS quarter_name, year(d) AS year_num,
  month(d) AS fiscal_month, quarter(d) AS fiscal_quarter, year(d) AS fiscal_year,
  dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday
FROM (SELECT CAST(unnest(generate_series(a, b + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
    FROM orders))""",
    "map_account": star(f"""
SELECT client_id, account_id, account_name, fully_qualified_name, classification, account_type,
  {TEXT_NULL} AS account_sub_type, parent_account_id IS NOT NULL AS is_sub_account,
  parent_account_id, TRUE AS is_active, {money('current_balance')} AS current_balance,
  'USD' AS currency_code FROM dim_account"""),
    "map_customer": star(f"""
SELECT client_id, customer_id, display_name, company_name, customer_id || '@x' AS email,
  billing_state, FALSE AS is_job, TRUE AS is_active, {money('balance')} AS balance,
  {TEXT_NULL} AS parent_customer_id FROM dim_customer"""),
    "map_vendor": star(f"""
SELECT client_id, vendor_id, display_name, vendor_id AS phone,
  CAST(vendor_id AS BIGINT) % 2 = 0 AS is_1099, TRUE AS is_active, {money('balance')} AS balance
FROM dim_vendor"""),
    "map_item": star(f"""
SELECT client_id, item_id, item_name, item_type, {money('unit_price')} AS unit_price,
  TRUE AS is_active, income_account_id, expense_account_id, FALSE AS track_qty FROM dim_item"""),
    "map_employee": star("""
SELECT client_id, CAST(s_suppkey AS VARCHAR) AS employee_id, s_name AS display_name,
  split_part(s_name, '#', 1) AS given_name, split_part(s_name, '#', 2) AS family_name,
  DATE '1995-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS hired_date,
  s_suppkey % 7 <> 0 AS is_active FROM supplier JOIN tenant ON s_nationkey = n_nationkey"""),
    "map_invoice": star(f"""
SELECT client_id, invoice_id, doc_number, txn_date, due_date, customer_id,
  {money('total_amount')} AS total_amount, {money('balance')} AS balance,
  {money('total_tax')} AS total_tax, 'NotSet' AS email_status, 'NeedToPrint' AS print_status
FROM fact_invoice"""),
    "map_bill": star(f"""
SELECT client_id, bill_id, txn_date, due_date, vendor_id, {money('total_amount')} AS total_amount,
  {money('balance')} AS balance FROM fact_bill"""),
    "map_payment": star(f"""
SELECT client_id, payment_id, txn_date, {money('total_amount')} AS total_amount, customer_id,
  deposit_to_account_id, CAST(0 AS DOUBLE) AS unapplied_amount FROM fact_payment"""),
    "map_purchase": star(f"""
SELECT client_id, purchase_id, txn_date, payment_type, {money('total_amount')} AS total_amount,
  account_id, vendor_id, 'Vendor' AS vendor_type, is_credit, 'PUR-' || purchase_id AS doc_number
FROM fact_purchase"""),
    "map_estimate": star(f"""
SELECT client_id, estimate_id, doc_number, txn_date, customer_id,
  {money('total_amount')} AS total_amount, txn_status, linked_invoice_id FROM fact_estimate"""),
    "map_generic": star(f"""
, t AS (SELECT unnest(string_split('{GENERIC}', ' ')) AS table_name)
SELECT table_name, client_id, customer_id AS id, display_name AS name,
  CASE WHEN CAST(customer_id AS BIGINT) % 2 = 1 THEN company_name || ':' || display_name
    ELSE display_name END AS fully_qualified_name,
  CASE WHEN CAST(customer_id AS BIGINT) % 3 <> 0 THEN CAST(customer_id AS BIGINT) % 5 <> 0
    ELSE TRUE END AS is_active FROM dim_customer, t"""),
    "report_latest": star(ALL_YEARS + """
SELECT client_id, 'report_agedreceivables' AS report_table, '2001-08-01' AS end_period,
  count(*) AS rows FROM rep GROUP BY 1"""),
    "flatten_invoice_lines": star(f"""
SELECT {LINE_COLUMNS.format(key='CAST(l_orderkey AS VARCHAR) AS invoice_id')}, {SALES},
  ship_date AS service_date FROM lt"""),
    "flatten_estimate_lines": star(f"""
SELECT {LINE_COLUMNS.format(key='CAST(l_orderkey AS VARCHAR) AS estimate_id')}, {SALES}
FROM lt WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""),
    **{f"flatten_{e}_lines": star(f"""
SELECT {LINE_COLUMNS.format(key=f'CAST(l_orderkey AS VARCHAR) AS {e}_id')}, {SALES},
  ship_date AS service_date, order_date AS txn_date, {money('total')} AS total_amount,
  CAST(o_custkey AS VARCHAR) AS party_id FROM lt""")
       for e in ("credit_memo", "sales_receipt", "refund_receipt")},
    "flatten_journal_lines": star(f"""
SELECT client_id, payment_id AS journal_entry_id, CAST(n AS VARCHAR) AS line_id,
  CAST(n AS BIGINT) AS line_num, CAST(NULL AS VARCHAR) AS description,
  {money('total_amount')} AS amount, ['Debit', 'Credit'][n] AS posting_type,
  CASE n WHEN 1 THEN deposit_to_account_id ELSE 'AR' END AS account_id,
  CAST(NULL AS VARCHAR) AS account_name, 'JournalEntryLineDetail' AS detail_type
FROM fact_payment, (SELECT unnest([1, 2]) AS n)"""),
    "flatten_bill_lines": star(f"""
SELECT {LINE_COLUMNS.format(key="l_orderkey || '-' || l_suppkey AS bill_id")}, {EXPENSE},
  CAST(l_linenumber AS BIGINT) AS line_num,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS DOUBLE) END AS quantity,
  CASE WHEN l_linenumber % 2 = 0 THEN {money('unit_price')} END AS unit_price,
  CAST(o_custkey AS VARCHAR) AS customer_name FROM lt WHERE l_returnflag = 'A'"""),
    "flatten_purchase_lines": star(f"""
SELECT {LINE_COLUMNS.format(key="l_orderkey || '-' || l_linenumber AS purchase_id")}, {EXPENSE}
FROM lt WHERE l_returnflag = 'R'"""),
    "flatten_payment_lines": star(f"""
SELECT client_id, payment_id, {money('total_amount')} AS amount, payment_id AS linked_invoice_id,
  'Invoice' AS linked_txn_type,
  (SELECT CAST(total AS VARCHAR) FROM ord WHERE CAST(o_orderkey AS VARCHAR) = payment_id)
    AS original_open_balance, 'INV-' || payment_id AS invoice_doc_number,
  CAST(1 AS BIGINT) AS line_num FROM fact_payment"""),
    "flatten_report": star(ALL_YEARS + """
SELECT client_id, 'AgedReceivables' AS report_name, section, row_type, row_ord,
  unnest([0, 1, 2])::BIGINT AS col_ord, unnest(['Status', 'Invoices', 'Total']) AS title,
  unnest(["Status", "Invoices", "Total"]) AS value FROM rep"""),
    "report_pivot": star(ALL_YEARS + f"""
SELECT client_id, 'report_agedreceivables' AS report_table, row_ord, {REPORT_COLUMNS} FROM rep"""),
    "report_titles": star("""
, o AS (SELECT o.client_id, n_name, c_mktsegment, year(order_date) AS y, strftime(order_date, '%b %Y') AS title, total
  FROM ord o JOIN cust c ON o_custkey = c_custkey
  WHERE year(order_date) IN (1997, 1998) AND month(order_date) % 5 <> length(o.client_id) % 5),
t AS (SELECT DISTINCT client_id, y, title FROM o),
s AS (SELECT client_id, n_name, c_mktsegment, y, sum(total) AS total, count(*) AS n FROM o GROUP BY ALL),
m AS (SELECT client_id, n_name, c_mktsegment, title, sum(total) AS total FROM o GROUP BY ALL),
n AS (SELECT client_id, n_name, y, sum(total) AS total FROM s GROUP BY ALL),
x AS (
  SELECT client_id, y, n_name, 'Data' AS row_type, 'Segment' AS title, c_mktsegment AS value FROM s
  UNION ALL SELECT client_id, y, n_name, 'Data', 'Total', CAST(n AS VARCHAR) FROM s
  UNION ALL SELECT s.client_id, s.y, s.n_name, 'Data', t.title, coalesce(CAST(m.total AS VARCHAR), '')
    FROM s JOIN t ON t.client_id = s.client_id AND t.y = s.y LEFT JOIN m ON m.client_id = s.client_id
      AND m.n_name = s.n_name AND m.c_mktsegment = s.c_mktsegment AND m.title = t.title
  UNION ALL SELECT client_id, y, n_name, 'Summary', 'Segment', 'Total ' || n_name FROM n
  UNION ALL SELECT client_id, y, n_name, 'Summary', 'Total', CAST(total AS VARCHAR) FROM n
  UNION ALL SELECT n.client_id, n.y, n_name, 'Summary', title, '' FROM n JOIN t ON t.client_id = n.client_id AND t.y = n.y)
SELECT client_id, 'MonthlySales' AS report_name, y || '-01-01' AS start_period, y || '-12-31' AS end_period,
  n_name AS section, row_type, title, value FROM x"""),
    "etl_report": star(ALL_YEARS + f"""
SELECT client_id, 'report_agedreceivables' AS report_table, row_ord, {REPORT_COLUMNS} FROM rep"""),
    "stream_refresh": star("""
, i AS (SELECT client_id, total_amount AS t, CAST(invoice_id AS BIGINT) % 10 AS k FROM fact_invoice),
r AS (SELECT client_id, 'new' AS verdict, t + 1 AS t FROM i WHERE k <> 3
  UNION ALL SELECT client_id, 'new', t FROM i WHERE k <> 4
  UNION ALL SELECT client_id, 'repeated', t FROM i WHERE k <> 4
  UNION ALL SELECT client_id, 'late', t + 2 FROM i WHERE k IN (4, 5)
  UNION ALL SELECT client_id, 'current', CASE WHEN k = 4 THEN t + 1 ELSE t END FROM i)
SELECT client_id, verdict, count(*) AS records, CAST(sum(t) AS DOUBLE) AS total FROM r GROUP BY ALL"""),
    "balances_by_pull": star(f"""
, i AS (SELECT *, CAST(invoice_id AS BIGINT) AS k FROM fact_invoice),
s AS (
  SELECT client_id, DATE '2001-07-31' AS day, total_amount + 1 AS total, balance FROM i WHERE k % 10 <> 3
  UNION ALL SELECT client_id, DATE '2001-08-01', total_amount, balance FROM i WHERE k % 10 <> 4
  UNION ALL SELECT client_id, DATE '2001-08-01', total_amount + 1, balance FROM i WHERE k % 10 = 4)
SELECT client_id, day, count(*) AS documents, CAST(sum(s.total) AS DOUBLE) AS total,
  CAST(sum(s.balance) FILTER (WHERE s.balance > 0) AS DOUBLE) AS total_open FROM s GROUP BY ALL"""),
    "backfill_reports": f"({one_year(1998)}) UNION ALL ({one_year(1999)})",
    "enforce_bool": messy("flag", "TRUE", "TRUE", "FALSE", "FALSE", "FALSE", "FALSE", kind="BOOLEAN"),
    "enforce_float": messy(
        "number", PRICE, PRICE, f"-{PRICE}", f"{PRICE} * 10", "NULL", "NULL", "NULL", "NULL",
        "NULL", "NULL", kind="DOUBLE"),
    "enforce_int": messy(
        "number", "o_orderkey", "o_orderkey", "NULL", "o_orderkey * 100", "NULL", "NULL",
        kind="BIGINT"),
    "enforce_date": messy(
        "day", "CAST(o_orderdate AS DATE)", "NULL", "NULL", "NULL", "NULL", "NULL", kind="DATE"),
    "enforce_datetime": messy(
        "stamp", f"{ORDER_DAY} || ' 00:00:00'", f"{ORDER_DAY} || ' 10:30:00'",
        f"{ORDER_DAY} || ' 10:30:15'", "NULL", "NULL", "NULL", kind="VARCHAR"),
    "dedup_keep_last": star("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice FROM li"""),
    "date_key": messy(
        "day_key", *["CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS BIGINT)"] * 3,
        "NULL", "NULL", kind="BIGINT"),
    "clean_invoice": star(f"""
SELECT client_id, invoice_id, doc_number, txn_date, due_date, customer_id,
  {money('total_amount')} AS total_amount, {money('balance')} AS balance,
  {money('total_tax')} AS total_tax, CAST(txn_date_key AS BIGINT) AS txn_date_key,
  CAST(due_date_key AS BIGINT) AS due_date_key FROM fact_invoice"""),
    "upsert_merge": star(f"""
SELECT client_id, invoice_id, txn_date, {money('''total_amount
  + CASE WHEN CAST(invoice_id AS BIGINT) % 2 = 0 OR CAST(invoice_id AS BIGINT) % 10 = 3
    THEN 1 ELSE 0 END''')} AS total_amount
FROM fact_invoice"""),
    "pk_violations": star("""
SELECT client_id, CAST(l_orderkey AS VARCHAR) AS invoice_id,
  CAST(l_linenumber AS VARCHAR) AS line_id, count(*) AS rows
FROM lineitem JOIN ord ON l_orderkey = o_orderkey GROUP BY ALL HAVING count(*) > 1"""),
    "pk_check_facts": star(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, client_id, count(*) AS rows, "
        f"count(*) - count(DISTINCT {key}) AS repeated FROM {t} GROUP BY client_id"
        for t, key in {
            "fact_invoice": "invoice_id", "fact_bill": "bill_id", "fact_purchase": "purchase_id",
            "fact_payment": "payment_id", "fact_estimate": "estimate_id",
            "fact_invoice_line": "(invoice_id, line_id)",
        }.items())),
    "etl_invoice": star(f"""
, l AS (SELECT client_id, invoice_id, sum(amount) AS a FROM fact_invoice_line GROUP BY ALL)
SELECT client_id, CAST(date_trunc('month', txn_date) AS DATE) AS month, count(*) AS invoices,
  {money('sum(total_amount)')} AS invoiced, {money('sum(total_tax)')} AS tax,
  {money('sum(a)')} AS revenue
FROM fact_invoice LEFT JOIN l USING (client_id, invoice_id) GROUP BY ALL"""),
    "revenue_from_documents": star(f"""
SELECT client_id, CAST(date_trunc('month', txn_date) AS DATE) AS month,
  {money('sum(amount)')} AS revenue, count(DISTINCT invoice_id) AS invoices
FROM fact_invoice_line GROUP BY ALL"""),
    "etl_daily": star(f"""
SELECT client_id, 'Invoice' AS source_name, 2 * count(*) AS archived, count(*) AS held,
  {money('sum(total_amount)')} AS total FROM fact_invoice GROUP BY 1
UNION ALL SELECT client_id, 'Payment', count(*), count(*), {money('sum(total_amount)')}
FROM fact_payment GROUP BY 1"""),
    "etl_quarantine": star("""
SELECT client_id, 'Invoice' AS source_name, 'damaged' AS reason, count(*) AS records
FROM fact_invoice WHERE CAST(invoice_id AS BIGINT) % 13 = 0 GROUP BY 1
UNION ALL SELECT client_id, 'Payment', 'no id', count(*)
FROM fact_payment WHERE CAST(payment_id AS BIGINT) % 7 = 0 GROUP BY 1
UNION ALL SELECT client_id, 'Mystery', 'unknown source', count(*) FROM dim_customer GROUP BY 1"""),
    "run_summary": star("""
SELECT client_id, 'Invoice' AS source_name, count(*) AS records,
  count(*) FILTER (WHERE CAST(invoice_id AS BIGINT) % 13 = 0) AS damaged
FROM fact_invoice GROUP BY 1
UNION ALL SELECT client_id, 'Payment', count(*), 0 FROM fact_payment GROUP BY 1"""),
    "join_invoice_star": star(f"""
SELECT l.client_id, {YEAR} AS year_num, 'Q' || quarter(txn_date) AS quarter_name, company_name,
  item_type, account_type, {money('sum(amount)')} AS amount
FROM fact_invoice_line l JOIN dim_customer USING (client_id, customer_id)
  JOIN dim_item USING (client_id, item_id) JOIN dim_account USING (client_id, account_id)
GROUP BY ALL"""),
    "join_due_date_role": star(f"""
SELECT client_id, {YEAR} AS year_num, year(due_date) AS due_year_num,
  month(due_date) AS due_month_num, {money('sum(total_amount)')} AS total, count(*) AS invoices
FROM fact_invoice GROUP BY ALL"""),
    "join_bill_star": star(f"""
SELECT l.client_id, year(b.txn_date) AS year_num, display_name, account_type,
  {money('sum(l.amount)')} AS amount
FROM fact_bill_line l JOIN fact_bill b USING (client_id, bill_id)
  JOIN dim_vendor USING (client_id, vendor_id)
  JOIN dim_account a ON a.client_id = l.client_id AND a.account_id = l.account_id GROUP BY ALL"""),
    "join_payment_star": star(f"""
SELECT client_id, {YEAR} AS year_num, month(txn_date) AS month_num, billing_state,
  {money('sum(total_amount)')} AS total, count(*) AS payments
FROM fact_payment JOIN dim_customer USING (client_id, customer_id) GROUP BY ALL"""),
    "join_purchase_star": star(f"""
SELECT client_id, {YEAR} AS year_num, display_name, payment_type,
  {money('sum(total_amount)')} AS total
FROM fact_purchase JOIN dim_vendor USING (client_id, vendor_id) GROUP BY ALL"""),
    "join_estimate_star": star(f"""
SELECT client_id, {YEAR} AS year_num, 'Q' || quarter(txn_date) AS quarter_name, company_name,
  txn_status, {money('sum(total_amount)')} AS total, count(*) AS estimates
FROM fact_estimate JOIN dim_customer USING (client_id, customer_id) GROUP BY ALL"""),
    "rls_semi_join": star(f"""
SELECT user_email, client_id, count(*) AS invoices, {money('sum(total_amount)')} AS total
FROM fact_invoice JOIN user_map USING (client_id) GROUP BY ALL"""),
}
