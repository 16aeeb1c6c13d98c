"""Expected dashboard reports."""

from .measures import CHANGE, COGS, DAYS, EXP, LATE, PAY, PUR, REV, YEAR, buckets
from .star import AS_OF, mean, money, ratio, star

MONTH_OF = "CAST(date_trunc('month', txn_date) AS DATE)"
LAST12 = f"""txn_date >= date_trunc('month', {AS_OF}) - INTERVAL 11 MONTH
  AND txn_date <= last_day({AS_OF})"""

ACCOUNTS = """
, activity AS (
  SELECT client_id, account_id, txn_date, amount, 'revenue' AS kind FROM fact_invoice_line
  UNION ALL
  SELECT l.client_id, account_id, b.txn_date, amount, 'bill'
  FROM fact_bill_line l JOIN fact_bill b USING (client_id, bill_id)
  UNION ALL
  SELECT client_id, expense_account_id, txn_date, total_amount, 'purchase'
  FROM fact_purchase WHERE NOT is_credit),
spend AS (
  SELECT client_id, vendor_id, txn_date, total_amount FROM fact_bill
  UNION ALL
  SELECT client_id, vendor_id, txn_date, total_amount FROM fact_purchase WHERE NOT is_credit)
"""

CUSTOMERS = """
, customer_sales AS (SELECT client_id, customer_id, sum(amount) AS revenue,
    count(DISTINCT invoice_id) AS invoice_count FROM fact_invoice_line GROUP BY ALL)
"""

ENDS = f"""
, ends AS (SELECT CAST(m AS DATE) AS month, least(last_day(m), {AS_OF}) AS month_end
  FROM (SELECT unnest(generate_series(date_trunc('month', {AS_OF}) - INTERVAL 11 MONTH,
    date_trunc('month', {AS_OF}), INTERVAL 1 MONTH)) AS m))
"""


def aging(fact: str, key: str, dim: str, edges: tuple[int, ...]) -> str:
    cols = ", ".join(f"{expr} AS {name}" for name, expr in buckets(edges).items())
    return star(f"""
, aged AS (SELECT client_id, {key}, {cols} FROM {fact} WHERE balance > 0 GROUP BY ALL)
SELECT aged.*, display_name FROM aged LEFT JOIN {dim} USING (client_id, {key})""")


def tree_sums(accounts: str, activity: str) -> str:
    """Sums along a tree: `accounts` (client_id, id, parent, name, classification) and `activity`
    (client_id, id, month, amount)."""
    return star(f"""
, a AS ({accounts}), act AS (SELECT client_id, id, month, sum(amount) AS amount FROM ({activity}) GROUP BY ALL),
up(client_id, id, anc) AS (
  SELECT a.client_id, a.id, b.id FROM a JOIN a b ON b.client_id = a.client_id AND b.id = a.parent
  UNION SELECT up.client_id, up.id, b.id FROM up JOIN a m ON m.client_id = up.client_id AND m.id = up.anc
    JOIN a b ON b.client_id = m.client_id AND b.id = m.parent),
loops AS (SELECT client_id, id FROM up WHERE id = anc),
lost AS (SELECT client_id, id FROM up WHERE (client_id, anc) IN (SELECT (client_id, id) FROM loops)
  UNION SELECT client_id, id FROM loops
  UNION SELECT a.client_id, a.id FROM a LEFT JOIN a b ON b.client_id = a.client_id AND b.id = a.parent
    WHERE a.parent IS NOT NULL AND b.id IS NULL),
n AS (SELECT a.client_id, a.id, CASE WHEN l.id IS NULL THEN a.parent ELSE 'Unassigned' END AS parent, name, classification
  FROM a LEFT JOIN lost l USING (client_id, id)
  UNION ALL SELECT DISTINCT client_id, 'Unassigned', NULL, NULL, NULL FROM lost),
c(client_id, id, anc, distance) AS (
  SELECT client_id, id, id, 0 FROM n
  UNION ALL SELECT c.client_id, c.id, n.parent, distance + 1
  FROM c JOIN n ON n.client_id = c.client_id AND n.id = c.anc AND n.parent IS NOT NULL),
d AS (SELECT client_id, id, max(distance) AS depth FROM c GROUP BY ALL),
s AS (SELECT c.client_id, anc AS id, month, sum(CASE WHEN distance = 0 THEN amount END) AS own, sum(amount) AS total
  FROM c JOIN act ON act.client_id = c.client_id AND act.id = c.id GROUP BY ALL)
SELECT client_id, id AS account_id, parent AS parent_account_id, CAST(depth AS BIGINT) AS depth, month,
  {money('own')} AS own, {money('s.total')} AS total, name AS account_name, classification
FROM s JOIN n USING (client_id, id) JOIN d USING (client_id, id)""").replace("WITH", "WITH RECURSIVE", 1)


# Every invoice's balance, added up anew for each month end.
HISTORY = f"""
, days AS (SELECT least(last_day(m), {AS_OF}) AS day FROM (SELECT unnest(generate_series(
    (SELECT CAST(date_trunc('month', min(txn_date)) AS TIMESTAMP) FROM fact_invoice),
    CAST({AS_OF} AS TIMESTAMP), INTERVAL 1 MONTH)) AS m)),
held AS (SELECT i.client_id, invoice_id, i.due_date, day, i.total_amount - coalesce(sum(p.total_amount), 0) AS balance
  FROM days JOIN fact_invoice i ON i.txn_date <= day
    LEFT JOIN fact_payment p ON p.client_id = i.client_id AND p.payment_id = i.invoice_id AND p.txn_date <= day
  GROUP BY i.client_id, invoice_id, i.due_date, day, i.total_amount)"""


def cash_balance(grain: str) -> str:
    start = "CAST({} AS DATE)" if grain == "day" else "CAST(date_trunc('week', {}) AS DATE)"
    return star(f"""
, d AS (SELECT client_id, {start.format('txn_date')} AS period,
    sum(CASE WHEN kind = 'payment' THEN amount ELSE -amount END) AS f
  FROM money_in_out WHERE kind IN ('payment', 'purchase') GROUP BY ALL),
e AS (SELECT client_id, min(period) AS a, greatest(max(period), {start.format(AS_OF)}) AS z FROM d GROUP BY 1),
c AS (SELECT client_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 {grain})) AS DATE) AS period FROM e),
b AS (SELECT client_id, sum(amount) AS position FROM bank GROUP BY 1),
r AS (SELECT client_id, period, coalesce(f, 0) AS flow, sum(coalesce(f, 0)) OVER (PARTITION BY client_id ORDER BY period) AS running,
    sum(coalesce(f, 0)) OVER (PARTITION BY client_id) AS whole FROM c LEFT JOIN d USING (client_id, period))
SELECT client_id, period, {money('flow')} AS net_flow, {money('running')} AS running_cash,
  {money('b.position - (whole - running)')} AS balance FROM r LEFT JOIN b USING (client_id)""")


def header_and_lines(kind: str, header: str, line: str) -> str:
    return f"""
SELECT '{kind}' AS kind, client_id, id, header_total, line_total
FROM ({header}) FULL JOIN ({line}) USING (client_id, id)"""


REPORTS = {
    "v_rev_exp_12m": star(f"""
SELECT client_id, {MONTH_OF} AS month, {money(REV)} AS revenue, {money(EXP)} AS expenses
FROM money_in_out WHERE kind <> 'payment' AND {LAST12} GROUP BY ALL"""),
    "v_revenue_by_item": star(f"""
SELECT client_id, item_type, {money('sum(amount)')} AS revenue
FROM fact_invoice_line LEFT JOIN dim_item USING (client_id, item_id) GROUP BY ALL"""),
    "v_top_customers": star(CUSTOMERS + f"""
SELECT client_id, customer_id, {money('revenue')} AS revenue,
  row_number() OVER (PARTITION BY client_id ORDER BY customer_sales.revenue DESC, customer_id)
    AS rank, display_name
FROM customer_sales LEFT JOIN dim_customer USING (client_id, customer_id) QUALIFY rank <= 5"""),
    "v_exec_summary": COGS + f"""
, y AS (SELECT client_id, {REV} AS rev, coalesce({REV}, 0) - coalesce({EXP}, 0) AS net
  FROM money_in_out WHERE {YEAR} AND kind <> 'payment' GROUP BY 1),
o AS (SELECT client_id, sum(balance) AS ar FROM fact_invoice WHERE balance > 0 GROUP BY 1),
b AS (SELECT client_id, sum(amount) AS cash FROM bank GROUP BY 1)
SELECT client_id, {money('y.rev')} AS revenue_ytd, {money('net')} AS net_income_ytd,
  {money('ar')} AS ar_total,
  CASE WHEN y.rev > 0 THEN round({money('ar')} / ({money('y.rev')} / {DAYS}), 6) END AS dso,
  {money('cash')} AS cash_position,
  {ratio('coalesce(r, 0) - coalesce(c, 0)', 'r', '0')} AS gross_margin
FROM dim_client LEFT JOIN y USING (client_id) LEFT JOIN o USING (client_id)
  LEFT JOIN b USING (client_id) LEFT JOIN rev USING (client_id) LEFT JOIN cogs USING (client_id)""",
    "v_pnl_matrix": star(ACCOUNTS + f"""
SELECT client_id, classification, {MONTH_OF} AS month, fully_qualified_name,
  CASE WHEN GROUPING({MONTH_OF}) = 1 THEN 'total' WHEN GROUPING(fully_qualified_name) = 1
    THEN 'month' ELSE 'account' END AS level,
  {money('sum(amount)')} AS amount
FROM activity JOIN dim_account USING (client_id, account_id)
GROUP BY GROUPING SETS ((client_id, classification, {MONTH_OF}, fully_qualified_name),
  (client_id, classification, {MONTH_OF}), (client_id, classification))"""),
    "v_pnl_hierarchy": tree_sums(
        "SELECT client_id, account_id AS id, parent_account_id AS parent, account_name AS name, classification FROM dim_account",
        "SELECT client_id, account_id AS id, " + MONTH_OF + " AS month, amount FROM activity").replace(", a AS (", ACCOUNTS + ", a AS (", 1),
    "v_item_hierarchy": tree_sums("""
SELECT client_id, 'P-' || item_id AS id, CASE WHEN k % 40 = 7 THEN 'P-unknown' WHEN k % 40 = 9 THEN 'P-' || (2 * k)
    WHEN k > 1 THEN 'P-' || (k // 2) END AS parent, item_name AS name, 'Revenue' AS classification
FROM (SELECT *, CAST(item_id AS BIGINT) AS k FROM dim_item)""", f"""
SELECT client_id, 'P-' || item_id AS id, {MONTH_OF} AS month, amount FROM fact_invoice_line"""),
    "v_pnl_waterfall": COGS + f"""
, t AS (SELECT client_id, {REV} AS r0, {EXP} AS e FROM money_in_out GROUP BY 1),
w AS (SELECT t.client_id, r0, coalesce(c, 0) AS c, coalesce(e, 0) AS e
  FROM t LEFT JOIN cogs USING (client_id))
SELECT client_id, unnest([1, 2, 3, 4, 5])::BIGINT AS step,
  unnest(['Revenue', 'Cost of Goods Sold', 'Gross Profit', 'Operating Expenses', 'Net Income'])
    AS label,
  unnest([{money('r0')}, {money('-c')}, {money('r0 - c')}, {money('-(e - c)')}, {money('r0 - e')}])
    AS amount FROM w""",
    "v_pnl_grains": star(f"""
, g AS (SELECT client_id, kind, amount, txn_date, unnest(['month', 'quarter', 'year']) AS grain
  FROM money_in_out WHERE kind <> 'payment')
SELECT client_id, grain, CAST(date_trunc(grain, txn_date) AS DATE) AS period,
  {money(REV)} AS revenue, {money(EXP)} AS expenses,
  {money(f"coalesce({REV}, 0) - coalesce({EXP}, 0)")} AS net_income FROM g GROUP BY ALL"""),
    "v_balance_sheet": star(f"""
, a AS (SELECT *, CASE classification WHEN 'Asset' THEN 'Current Assets'
    WHEN 'Liability' THEN 'Current Liabilities' ELSE 'Equity' END AS section
  FROM dim_account WHERE classification IN ('Asset', 'Liability', 'Equity'))
SELECT client_id, classification, section, account_type, CASE WHEN GROUPING(section) = 1
    THEN 'classification' WHEN GROUPING(account_type) = 1 THEN 'section' ELSE 'account type' END
  AS level, {money('sum(current_balance)')} AS balance
FROM a GROUP BY GROUPING SETS ((client_id, classification, section, account_type),
  (client_id, classification, section), (client_id, classification))
UNION ALL SELECT client_id, 'Liabilities and Equity', NULL, NULL, 'total',
  {money('sum(current_balance)')} FROM a WHERE classification <> 'Asset' GROUP BY 1"""),
    "v_customer_tree": star("""
, c AS (SELECT client_id, CAST(customer_id AS BIGINT) AS id FROM dim_customer),
p AS (SELECT c.client_id, c.id, up.id AS parent FROM c LEFT JOIN c up
  ON up.client_id = c.client_id AND up.id = c.id // 2 AND c.id > 0),
w AS (SELECT client_id, id, 0 AS depth, id AS root, CAST(id AS VARCHAR) AS path FROM p
  WHERE parent IS NULL
  UNION ALL SELECT p.client_id, p.id, depth + 1, root, path || '/' || p.id
  FROM w JOIN p ON p.client_id = w.client_id AND p.parent = w.id)
SELECT client_id, CAST(id AS VARCHAR) AS customer_id, CAST(depth AS BIGINT) AS depth,
  CAST(root AS VARCHAR) AS root, path, FALSE AS cyclic FROM w""").replace("WITH", "WITH RECURSIVE", 1),
    "v_balance_check": star(f"""
, s AS (SELECT client_id,
    sum(CASE WHEN classification = 'Asset' THEN current_balance END) AS a,
    sum(CASE WHEN classification = 'Liability' THEN current_balance END) AS l,
    sum(CASE WHEN classification = 'Equity' THEN current_balance END) AS e
  FROM dim_account GROUP BY 1)
SELECT client_id, {money('a')} AS assets, {money('l')} AS liabilities, {money('e')} AS equity,
  {money('a - l - e')} AS difference, a - l - e = 0 AS balanced FROM s"""),
    "v_trial_balance": star(f"""
, s AS (SELECT *, current_balance
    * (CASE WHEN classification IN ('Asset', 'Expense') THEN 1 ELSE -1 END) AS signed
  FROM dim_account)
SELECT client_id, account_id, account_name, classification,
  {money('greatest(signed, 0)')} AS debit, {money('greatest(-signed, 0)')} AS credit FROM s"""),
    "v_account_tree": star("""
SELECT client_id, account_id, CAST(CASE WHEN parent_account_id IS NULL THEN 0 ELSE 1 END AS BIGINT)
  AS depth, coalesce(parent_account_id, account_id) AS root,
  concat_ws('/', parent_account_id, account_id) AS path, FALSE AS cyclic FROM dim_account"""),
    "v_cash_walk": star(f"""
, f AS (SELECT client_id, {PAY} AS i, {PUR} AS o FROM money_in_out GROUP BY 1),
b AS (SELECT client_id, sum(amount) AS closing FROM bank GROUP BY 1)
SELECT client_id, {money('closing - (coalesce(i, 0) - coalesce(o, 0))')} AS opening,
  {money('i')} AS cash_in, {money('o')} AS cash_out, {money('b.closing')} AS closing
FROM f FULL JOIN b USING (client_id)"""),
    "v_cash_trend": cash_balance("day"),
    "v_cash_trend_weekly": cash_balance("week"),
    "v_balance_as_of": star(f"""
{HISTORY}, r AS (SELECT client_id, day,
    {money("sum(balance) FILTER (WHERE due_date >= day)")} AS not_due,
    {money("sum(balance) FILTER (WHERE day - due_date BETWEEN 1 AND 30)")} AS days_1_30,
    {money("sum(balance) FILTER (WHERE day - due_date BETWEEN 31 AND 60)")} AS days_31_60,
    {money("sum(balance) FILTER (WHERE day - due_date BETWEEN 61 AND 90)")} AS days_61_90,
    {money("sum(balance) FILTER (WHERE day - due_date > 90)")} AS over_90,
    {money("sum(balance) FILTER (WHERE due_date IS NULL)")} AS undated,
    sum(balance) AS open_sum, count(*) AS open_invoices FROM held WHERE balance > 0 GROUP BY ALL),
f AS (SELECT client_id, txn_date, sum(CASE kind WHEN 'payment' THEN amount ELSE -amount END) AS flow
  FROM money_in_out WHERE kind IN ('payment', 'purchase') GROUP BY ALL),
b AS (SELECT client_id, sum(amount) AS position FROM bank GROUP BY 1),
c AS (SELECT b.client_id, day, position - coalesce((SELECT sum(flow) FROM f WHERE f.client_id = b.client_id AND txn_date > day), 0) AS cash
  FROM b CROSS JOIN days)
SELECT client_id, day, not_due, days_1_30, days_31_60, days_61_90, over_90, undated, {money('open_sum')} AS total_open,
  CAST(open_invoices AS BIGINT) AS open_invoices, {money('c.cash')} AS cash,
  {money('coalesce(open_sum, 0) + coalesce(c.cash, 0)')} AS current_assets
FROM r FULL JOIN c USING (client_id, day)"""),
    "v_dso_history": star(f"""
{HISTORY}, r AS (SELECT client_id, day, sum(balance) AS ar FROM held WHERE balance > 0 GROUP BY ALL),
y AS (SELECT client_id, day, sum(amount) AS ytd FROM days JOIN fact_invoice_line
  ON txn_date <= day AND txn_date >= date_trunc('year', day) GROUP BY ALL),
j AS (SELECT *, date_diff('day', CAST(date_trunc('year', day) AS DATE), day) AS n FROM r FULL JOIN y USING (client_id, day))
SELECT client_id, day, {money('ar')} AS total_open, {money('ytd')} AS revenue_ytd,
  CASE WHEN ytd > 0 AND n > 0 THEN round({money('ar')} / ({money('ytd')} / n), 6) END AS dso FROM j"""),
    "v_cash_by_party": star(f"""
SELECT client_id, 'in' AS direction, customer_id AS party_id, display_name AS party,
  {money('sum(total_amount)')} AS amount
FROM fact_payment LEFT JOIN dim_customer USING (client_id, customer_id) GROUP BY ALL
UNION ALL
SELECT p.client_id, 'out', NULL, account_type, {money('sum(total_amount)')}
FROM fact_purchase p LEFT JOIN dim_account a
  ON a.client_id = p.client_id AND a.account_id = p.expense_account_id
WHERE NOT is_credit GROUP BY ALL"""),
    "v_ar_aging_customer": aging("fact_invoice", "customer_id", "dim_customer", (30, 60, 90)),
    "v_ap_aging_vendor": aging("fact_bill", "vendor_id", "dim_vendor", (30, 60)),
    "v_open_invoices": star(f"""
SELECT f.client_id, f.customer_id, {money('f.balance')} AS balance, invoice_id, doc_number, txn_date,
  due_date, {money('total_amount')} AS total_amount, {LATE} AS days_outstanding, display_name
FROM fact_invoice f LEFT JOIN dim_customer USING (client_id, customer_id) WHERE f.balance > 0"""),
    "v_open_bills": star(f"""
SELECT f.client_id, f.vendor_id, {money('f.balance')} AS balance, bill_id, txn_date, due_date,
  {money('total_amount')} AS total_amount, {LATE} AS days_outstanding, display_name
FROM fact_bill f LEFT JOIN dim_vendor USING (client_id, vendor_id) WHERE f.balance > 0"""),
    "v_dso_trend": star(ENDS + f"""
, o AS (SELECT client_id, sum(balance) AS ar FROM fact_invoice WHERE balance > 0 GROUP BY 1),
y AS (SELECT o.client_id, ar, month_end, (SELECT sum(amount) FROM fact_invoice_line l
    WHERE l.client_id = o.client_id AND l.txn_date <= month_end
      AND l.txn_date >= date_trunc('year', month_end)) AS ytd,
    date_diff('day', CAST(date_trunc('year', month_end) AS DATE), month_end) AS days
  FROM o CROSS JOIN ends)
SELECT client_id, month_end, {money('ytd')} AS revenue_ytd,
  CASE WHEN ytd > 0 AND days > 0 THEN round({money('ar')} / ({money('ytd')} / days), 6) END AS dso
FROM y"""),
    "v_dpo_trend": star(ENDS + f"""
, o AS (SELECT client_id, sum(balance) AS ap FROM fact_bill WHERE balance > 0 GROUP BY 1),
y AS (SELECT o.client_id, ap, month_end, (SELECT sum(total_amount) FROM fact_bill l
    WHERE l.client_id = o.client_id AND l.txn_date <= month_end) AS billed,
    date_diff('day', CAST(date_trunc('year', month_end) AS DATE), month_end) AS days
  FROM o CROSS JOIN ends)
SELECT client_id, month_end, {money('billed')} AS billed,
  CASE WHEN billed > 0 AND days > 0 THEN round({money('ap')} / ({money('billed')} / days), 6) END
    AS dpo FROM y"""),
    "v_ap_by_category": star(f"""
, l AS (SELECT client_id, bill_id, account_id, CAST(round(sum(amount) * 100) AS HUGEINT) AS part FROM fact_bill_line GROUP BY ALL),
j AS (SELECT b.client_id, b.bill_id, account_id, CAST(round(balance * 100) AS HUGEINT) AS cents, coalesce(part, 0) AS part,
    sum(coalesce(part, 0)) OVER (PARTITION BY b.client_id, b.bill_id) AS whole
  FROM fact_bill b LEFT JOIN l USING (client_id, bill_id) WHERE balance > 0),
q AS (SELECT *, CASE WHEN whole = 0 THEN 0 ELSE (cents * part - (((cents * part) % whole) + whole) % whole) // whole END AS low,
    CASE WHEN whole = 0 THEN 0 ELSE (((cents * part) % whole) + whole) % whole END AS remainder FROM j),
s AS (SELECT client_id, CASE WHEN whole <> 0 THEN account_id END AS account_id, CASE WHEN whole = 0
    THEN CASE WHEN row_number() OVER (PARTITION BY client_id, bill_id ORDER BY account_id NULLS FIRST) = 1 THEN cents ELSE 0 END
    ELSE low + CASE WHEN row_number() OVER (PARTITION BY client_id, bill_id ORDER BY remainder DESC, account_id NULLS FIRST)
      <= cents - sum(low) OVER (PARTITION BY client_id, bill_id) THEN 1 ELSE 0 END END AS share FROM q)
SELECT s.client_id, coalesce(account_type, 'Unassigned') AS account_type, CAST(sum(share) / 100.0 AS DOUBLE) AS open_amount
FROM s LEFT JOIN dim_account a ON a.client_id = s.client_id AND a.account_id = s.account_id GROUP BY ALL"""),
    "v_revenue_cumulative": star(f"""
, mm AS (SELECT client_id, {MONTH_OF} AS month, sum(amount) AS r FROM fact_invoice_line GROUP BY ALL)
SELECT client_id, month, {money('r')} AS revenue,
  {money('sum(r) OVER (PARTITION BY client_id ORDER BY month)')} AS cumulative FROM mm"""),
    "v_top_categories": star(f"""
, c AS (SELECT client_id, item_type, {MONTH_OF} AS month, sum(amount) AS r
  FROM fact_invoice_line JOIN dim_item USING (client_id, item_id) GROUP BY ALL),
best AS (SELECT client_id, item_type FROM c GROUP BY client_id, item_type QUALIFY
  row_number() OVER (PARTITION BY client_id ORDER BY sum(r) DESC, item_type) <= 5)
SELECT client_id, item_type, month, {money('r')} AS revenue
FROM c JOIN best USING (client_id, item_type)"""),
    "v_customer_ranking": star(CUSTOMERS + f"""
SELECT client_id, customer_id, {money('revenue')} AS revenue, invoice_count,
  rank() OVER (PARTITION BY client_id ORDER BY customer_sales.revenue DESC) AS rank,
  {mean('customer_sales.revenue', 'invoice_count')} AS average_invoice, display_name
FROM customer_sales LEFT JOIN dim_customer USING (client_id, customer_id)"""),
    "v_customer_trend": star(f"""
SELECT client_id, customer_id, {MONTH_OF} AS month, {money('sum(amount)')} AS revenue
FROM fact_invoice_line WHERE {LAST12} GROUP BY ALL"""),
    "v_expense_by_type": star(ACCOUNTS + f"""
SELECT client_id, account_type, {money('sum(amount)')} AS expenses
FROM activity LEFT JOIN dim_account USING (client_id, account_id)
WHERE kind <> 'revenue' GROUP BY ALL"""),
    "v_largest_expense": star(ACCOUNTS + f"""
, t AS (SELECT client_id, account_type, sum(amount) AS e
  FROM activity LEFT JOIN dim_account USING (client_id, account_id)
  WHERE kind <> 'revenue' GROUP BY ALL)
SELECT client_id, account_type, {money('e')} AS expenses FROM t
QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY e DESC, account_type) = 1"""),
    "v_expense_yoy": star(f"""
, mm AS (SELECT client_id, {MONTH_OF} AS month, sum(amount) AS revenue FROM money_in_out
  WHERE kind IN ('bill', 'purchase') GROUP BY ALL),
shifted AS (SELECT client_id, CAST(month + INTERVAL 12 MONTH AS DATE) AS month, revenue AS prior
  FROM mm)
SELECT client_id, month, {money('revenue')} AS expenses, {money('prior')} AS prior, {CHANGE}
FROM mm FULL JOIN shifted USING (client_id, month)"""),
    "v_expense_mix": star(ACCOUNTS + f"""
, best AS (SELECT client_id, account_id, account_id AS category FROM activity
  WHERE kind <> 'revenue' GROUP BY client_id, account_id QUALIFY
  row_number() OVER (PARTITION BY client_id ORDER BY sum(amount) DESC, account_id) <= 5)
SELECT client_id, {MONTH_OF} AS month, coalesce(category, 'Other') AS category,
  {money('sum(amount)')} AS expenses
FROM activity LEFT JOIN best USING (client_id, account_id) WHERE kind <> 'revenue' GROUP BY ALL"""),
    "v_top_vendors": star(ACCOUNTS + f"""
, t AS (SELECT client_id, vendor_id, sum(total_amount) AS total,
    sum(CASE WHEN date_trunc('month', txn_date) = date_trunc('month', {AS_OF})
      THEN total_amount END) AS revenue,
    sum(CASE WHEN date_trunc('month', txn_date) = date_trunc('month', {AS_OF}) - INTERVAL 1 MONTH
      THEN total_amount END) AS prior
  FROM spend GROUP BY ALL)
SELECT client_id, vendor_id, {money('total')} AS total_spend, {money('revenue')} AS current_month,
  {money('prior')} AS prior_month,
  row_number() OVER (PARTITION BY client_id ORDER BY total DESC, vendor_id) AS rank, {CHANGE},
  display_name
FROM t LEFT JOIN dim_vendor USING (client_id, vendor_id) QUALIFY rank <= 10"""),
    "v_vendor_share": star(ACCOUNTS + f"""
, t AS (SELECT client_id, vendor_id, sum(total_amount) AS s FROM spend GROUP BY ALL),
w AS (SELECT *, sum(s) OVER (PARTITION BY client_id) AS whole,
  row_number() OVER (PARTITION BY client_id ORDER BY s DESC, vendor_id) AS rank FROM t)
SELECT client_id, vendor_id, {money('s')} AS spend, rank, {money('whole')} AS total_spend,
  {ratio('s', 'whole', '0')} AS share FROM w WHERE rank <= 5"""),
    "v_reconcile": star(f"""
, docs AS ({' UNION ALL '.join([
    header_and_lines(
        'invoice', "SELECT client_id, invoice_id AS id, total_amount AS header_total FROM fact_invoice",
        "SELECT client_id, invoice_id AS id, sum(amount) AS line_total FROM fact_invoice_line GROUP BY ALL"),
    header_and_lines(
        'bill', "SELECT client_id, bill_id AS id, total_amount AS header_total FROM fact_bill",
        "SELECT client_id, bill_id AS id, sum(amount) AS line_total FROM fact_bill_line GROUP BY ALL"),
    header_and_lines(
        'purchase',
        "SELECT client_id, purchase_id AS id, total_amount AS header_total FROM fact_purchase",
        "SELECT client_id, purchase_id AS id, total_amount AS line_total FROM fact_purchase"),
    header_and_lines(
        'payment',
        "SELECT client_id, payment_id AS id, total_amount AS header_total FROM fact_payment",
        "SELECT client_id, payment_id AS id, total_amount AS line_total FROM fact_payment"),
    header_and_lines(
        'estimate',
        "SELECT client_id, estimate_id AS id, total_amount AS header_total FROM fact_estimate",
        "SELECT client_id, invoice_id AS id, sum(amount) AS line_total FROM fact_invoice_line "
        "WHERE invoice_id IN (SELECT estimate_id FROM fact_estimate) GROUP BY ALL"),
])})
SELECT client_id, kind, count(*) AS documents,
  count(*) FILTER (WHERE header_total IS DISTINCT FROM line_total) AS differing,
  {money('sum(header_total)')} AS header_total, {money('sum(line_total)')} AS line_total
FROM docs GROUP BY ALL"""),
}
