"""DuckDB definitions of the derived star tables, as one shared WITH clause.

Averages and halves are stated in whole cents so that rounding is exact on both sides.
"""

AS_OF = "DATE '2001-08-01'"

STAR = """
WITH tenant AS (
  SELECT n_nationkey, n_name, r_name AS client_id
  FROM nation JOIN region ON n_regionkey = r_regionkey),
cust AS (SELECT * FROM customer JOIN tenant ON c_nationkey = n_nationkey),
ord AS (
  SELECT client_id, c_nationkey, o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
    CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(o_orderdate AS DATE) AS order_date,
    CAST(CASE o_orderstatus
      WHEN 'O' THEN CAST(o_totalprice AS DECIMAL(18,2))
      WHEN 'P' THEN CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 1) // 2 AS DECIMAL(18,2))
                    * CAST(0.01 AS DECIMAL(3,2))
      ELSE 0 END AS DECIMAL(18,2)) AS balance
  FROM orders JOIN cust ON o_custkey = c_custkey),
li AS (
  SELECT *, CAST(l_shipdate AS DATE) AS ship_date,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
         * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS amount,
    (2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
      // (2 * CAST(l_quantity AS BIGINT)) / 100.0 AS unit_price
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC,
    l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_shipdate DESC, l_discount DESC,
    l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1),
lt AS (
  SELECT li.*, ord.*, p_name, p_type,
    CAST(round(amount * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS tax
  FROM li JOIN ord ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
dim_client AS (SELECT r_name AS client_id, r_name AS client_name, TRUE AS is_active FROM region),
dim_customer AS (
  SELECT client_id, CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS display_name,
    c_mktsegment AS company_name, n_name AS billing_state,
    CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM cust),
dim_vendor AS (
  SELECT r_name AS client_id, CAST(s_suppkey AS VARCHAR) AS vendor_id, s_name AS display_name,
    CAST(s_acctbal AS DECIMAL(18,2)) AS balance FROM supplier CROSS JOIN region),
dim_item AS (
  SELECT r_name AS client_id, CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_name,
    p_type AS item_type, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
    'INC-' || p_type AS income_account_id, 'EXP-' || p_type AS expense_account_id
  FROM part CROSS JOIN region),
fact_invoice AS (
  SELECT client_id, CAST(o_orderkey AS VARCHAR) AS invoice_id, 'INV-' || o_orderkey AS doc_number,
    order_date AS txn_date, order_date + 30 AS due_date, CAST(o_custkey AS VARCHAR) AS customer_id,
    total AS total_amount, balance, coalesce(t.tax, 0) AS total_tax,
    CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS txn_date_key,
    CAST(strftime(order_date + 30, '%Y%m%d') AS INTEGER) AS due_date_key
  FROM ord LEFT JOIN (SELECT o_orderkey AS k, sum(tax) AS tax FROM lt GROUP BY 1) t
    ON o_orderkey = k),
fact_invoice_line AS (
  SELECT client_id, CAST(l_orderkey AS VARCHAR) AS invoice_id,
    CAST(l_linenumber AS VARCHAR) AS line_id, l_linenumber AS line_num, amount,
    l_quantity AS quantity, unit_price, CAST(l_partkey AS VARCHAR) AS item_id,
    p_name AS item_name, 'INC-' || p_type AS account_id, p_type AS account_name,
    ship_date AS service_date, order_date AS txn_date, CAST(o_custkey AS VARCHAR) AS customer_id
  FROM lt),
fact_payment AS (
  SELECT client_id, CAST(o_orderkey AS VARCHAR) AS payment_id,
    order_date + CAST(o_orderkey % 60 AS INTEGER) AS txn_date, total - balance AS total_amount,
    CAST(o_custkey AS VARCHAR) AS customer_id, 'BANK-' || c_nationkey AS deposit_to_account_id
  FROM ord WHERE o_orderstatus IN ('P', 'F')),
fact_bill AS (
  SELECT client_id, l_orderkey || '-' || l_suppkey AS bill_id, min(ship_date) AS txn_date,
    min(ship_date) + 45 AS due_date, CAST(l_suppkey AS VARCHAR) AS vendor_id,
    sum(amount) AS total_amount,
    sum(CASE WHEN l_linestatus = 'O' THEN amount ELSE 0 END) AS balance
  FROM lt WHERE l_returnflag = 'A' GROUP BY client_id, l_orderkey, l_suppkey),
fact_bill_line AS (
  SELECT client_id, l_orderkey || '-' || l_suppkey AS bill_id,
    CAST(l_linenumber AS VARCHAR) AS line_id, amount, 'EXP-' || p_type AS account_id,
    p_type AS account_name FROM lt WHERE l_returnflag = 'A'),
fact_purchase AS (
  SELECT client_id, l_orderkey || '-' || l_linenumber AS purchase_id, ship_date AS txn_date,
    CASE l_linenumber % 3 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Check' ELSE 'CreditCard' END
      AS payment_type, amount AS total_amount, 'BANK-' || c_nationkey AS account_id,
    CAST(l_suppkey AS VARCHAR) AS vendor_id,
    (l_linestatus = 'F' AND l_linenumber = 1) AS is_credit,
    'EXP-' || p_type AS expense_account_id
  FROM lt WHERE l_returnflag = 'R'),
fact_estimate AS (
  SELECT client_id, CAST(o_orderkey AS VARCHAR) AS estimate_id, 'EST-' || o_orderkey AS doc_number,
    order_date AS txn_date, CAST(o_custkey AS VARCHAR) AS customer_id, total AS total_amount,
    CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Pending' END AS txn_status,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) END AS linked_invoice_id
  FROM ord WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
bank AS (
  SELECT client_id, c_nationkey, n_name, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS amount
  FROM cust GROUP BY ALL),
ar AS (SELECT client_id, sum(balance) AS amount FROM ord GROUP BY 1),
ap AS (SELECT client_id, sum(balance) AS amount FROM fact_bill GROUP BY 1),
dim_account AS (
  SELECT r_name AS client_id, 'INC-' || p_type AS account_id, p_type AS account_name,
    'INC:' || p_type AS fully_qualified_name, 'Revenue' AS classification,
    'Income' AS account_type, 'INC' AS parent_account_id,
    CAST(0 AS DECIMAL(18,2)) AS current_balance
  FROM (SELECT DISTINCT p_type FROM part) CROSS JOIN region
  UNION ALL
  SELECT r_name, 'EXP-' || p_type, p_type, 'EXP:' || p_type, 'Expense',
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'Cost of Goods Sold'
      ELSE 'Expense' END, 'EXP', 0
  FROM (SELECT DISTINCT p_type FROM part) CROSS JOIN region
  UNION ALL
  SELECT r_name, a, a, a, c, t, NULL, 0 FROM region
    CROSS JOIN (VALUES ('INC', 'Revenue', 'Income'), ('EXP', 'Expense', 'Expense')) v(a, c, t)
  UNION ALL
  SELECT client_id, 'BANK-' || c_nationkey, n_name, 'BANK-' || c_nationkey, 'Asset', 'Bank',
    NULL, amount FROM bank
  UNION ALL
  SELECT client_id, 'AR', 'AR', 'AR', 'Asset', 'Accounts Receivable', NULL, amount FROM ar
  UNION ALL
  SELECT client_id, 'AP', 'AP', 'AP', 'Liability', 'Accounts Payable', NULL, amount FROM ap
  UNION ALL
  SELECT client_id, 'EQ', 'EQ', 'EQ', 'Equity', 'Equity', NULL, sum(amount) FROM (
    SELECT client_id, amount FROM bank UNION ALL SELECT client_id, amount FROM ar
    UNION ALL SELECT client_id, -amount FROM ap) GROUP BY 1),
user_map AS (
  SELECT * FROM (VALUES ('user1@x', 'AFRICA'), ('user1@x', 'ASIA'), ('user2@x', 'EUROPE'))
    v(user_email, client_id)),
money_in_out AS (
  SELECT client_id, txn_date, 'revenue' AS kind, amount FROM fact_invoice_line
  UNION ALL
  SELECT l.client_id, b.txn_date, 'bill', l.amount
  FROM fact_bill_line l JOIN fact_bill b USING (client_id, bill_id)
  UNION ALL
  SELECT client_id, txn_date, 'purchase', total_amount FROM fact_purchase WHERE NOT is_credit
  UNION ALL
  SELECT client_id, txn_date, 'payment', total_amount FROM fact_payment)
"""


def star(select: str) -> str:
    """A statement over the star tables."""
    return STAR + select


def money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def ratio(a: str, b: str, alt: str = "NULL") -> str:
    return (
        f"CASE WHEN coalesce({b}, 0) <> 0 THEN "
        f"round(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE), 6) ELSE CAST({alt} AS DOUBLE) END"
    )


def mean(total: str, n: str) -> str:
    """Mean of non-negative money, half a cent rounded up."""
    return (
        f"CAST(((2 * CAST(({total}) * 100 AS HUGEINT) + {n}) // (2 * {n})) AS DOUBLE) / 100"
    )
