"""Expected measures."""

from .star import AS_OF, mean, money, ratio, star

YEAR = f"txn_date BETWEEN date_trunc('year', {AS_OF}) AND {AS_OF}"
QUARTER = f"txn_date BETWEEN date_trunc('quarter', {AS_OF}) AND {AS_OF}"
MONTH = f"txn_date BETWEEN date_trunc('month', {AS_OF}) AND {AS_OF}"
DAYS = f"date_diff('day', CAST(date_trunc('year', {AS_OF}) AS DATE), {AS_OF})"


def per_client(table: str, where: str = "TRUE", **columns: str) -> str:
    cols = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return star(f"SELECT client_id, {cols} FROM {table} WHERE {where} GROUP BY client_id")


def total(kind: str) -> str:
    return f"sum(CASE WHEN kind IN ({kind}) THEN amount END)"


REV, EXP, BILL, PUR, PAY = (
    total("'revenue'"), total("'bill', 'purchase'"), total("'bill'"), total("'purchase'"),
    total("'payment'"),
)


def flows(where: str = "TRUE", **columns: str) -> str:
    return per_client("money_in_out", where, **columns)


def against(months: int, select: str) -> str:
    return star(f"""
, monthly AS (SELECT client_id, CAST(date_trunc('month', txn_date) AS DATE) AS month,
    sum(amount) AS revenue FROM fact_invoice_line GROUP BY ALL),
shifted AS (SELECT client_id, CAST(month + INTERVAL {months} MONTH AS DATE) AS month,
    revenue AS prior FROM monthly),
paired AS (SELECT * FROM monthly FULL JOIN shifted USING (client_id, month))
SELECT client_id, month, {select} FROM paired""")


PAIR = f"{money('revenue')} AS revenue, {money('prior')} AS prior"
CHANGE = f"""CASE WHEN prior <> 0 THEN
  {ratio('coalesce(revenue, 0) - prior', 'abs(prior)')} END AS change"""

LATE = f"date_diff('day', due_date, {AS_OF})"


def bucket(cond: str) -> str:
    return money(f"sum(CASE WHEN {cond} THEN balance END)")


def buckets(edges: tuple[int, ...]) -> dict[str, str]:
    cols, low = {"not_due": bucket(f"due_date >= {AS_OF}")}, 1
    for edge in edges:
        cols[f"days_{low}_{edge}"] = bucket(f"{LATE} BETWEEN {low} AND {edge}")
        low = edge + 1
    cols[f"over_{edges[-1]}"] = bucket(f"{LATE} > {edges[-1]}")
    cols["undated"] = bucket("due_date IS NULL")
    cols["total_open"] = money("sum(balance)")
    return cols


COGS = star("""
, rev AS (SELECT client_id, sum(amount) AS r FROM fact_invoice_line GROUP BY 1),
cogs AS (SELECT client_id, sum(amount) AS c FROM fact_bill_line
  JOIN dim_account USING (client_id, account_id)
  WHERE account_type = 'Cost of Goods Sold' GROUP BY 1)
""")

MEASURES = {
    "total_revenue": per_client("fact_invoice_line", total_revenue=money("sum(amount)")),
    "revenue_mtd": per_client("fact_invoice_line", MONTH, revenue=money("sum(amount)")),
    "revenue_qtd": per_client("fact_invoice_line", QUARTER, revenue=money("sum(amount)")),
    "revenue_ytd": per_client("fact_invoice_line", YEAR, revenue=money("sum(amount)")),
    "revenue_to_date": per_client(
        "fact_invoice_line", YEAR,
        revenue_mtd=money(f"sum(amount) FILTER (WHERE {MONTH})"),
        revenue_qtd=money(f"sum(amount) FILTER (WHERE {QUARTER})"),
        revenue_ytd=money("sum(amount)")),
    "revenue_prior_month": against(1, PAIR),
    "revenue_mom": against(1, CHANGE),
    "revenue_prior_year": against(12, PAIR),
    "revenue_yoy": against(12, CHANGE),
    "avg_invoice": per_client(
        "fact_invoice", average_invoice=mean("sum(total_amount)", "count(total_amount)")),
    "invoice_count": per_client("fact_invoice", invoice_count="count(*)"),
    "revenue_per_customer": star(f"""
, r AS (SELECT client_id, sum(amount) AS rev FROM fact_invoice_line GROUP BY 1),
c AS (SELECT client_id, count(DISTINCT customer_id) AS customers FROM fact_invoice GROUP BY 1)
SELECT client_id, {money('rev')} AS total_revenue, customers,
  {ratio('rev', 'customers', '0')} AS revenue_per_customer FROM r FULL JOIN c USING (client_id)"""),
    "ar_total": per_client("fact_invoice", "balance > 0", total_open=money("sum(balance)")),
    "ar_buckets": per_client("fact_invoice", "balance > 0", **buckets((30, 60, 90))),
    "dso": star(f"""
, a AS (SELECT client_id, sum(balance) AS ar FROM fact_invoice WHERE balance > 0 GROUP BY 1),
r AS (SELECT client_id, sum(amount) AS ytd FROM fact_invoice_line WHERE {YEAR} GROUP BY 1)
SELECT client_id, {money('ar')} AS ar_total, {money('ytd')} AS revenue_ytd,
  CASE WHEN ytd > 0 THEN round({money('ar')} / ({money('ytd')} / {DAYS}), 6) END AS dso
FROM a FULL JOIN r USING (client_id)"""),
    "open_invoice_count": per_client("fact_invoice", "balance > 0", open_count="count(*)"),
    "collection_rate": flows(
        "kind IN ('revenue', 'payment')", payment=money(PAY), revenue=money(REV),
        collection_rate=ratio(PAY, REV, "0")),
    "ap_total": per_client("fact_bill", "balance > 0", total_open=money("sum(balance)")),
    "ap_buckets": per_client("fact_bill", "balance > 0", **buckets((30, 60))),
    "dpo": star(f"""
SELECT client_id, {money('ap')} AS ap_total, {money('billed')} AS billed,
  CASE WHEN billed > 0 THEN round({money('ap')} / ({money('billed')} / {DAYS}), 6) END AS dpo
FROM (SELECT client_id, sum(CASE WHEN balance > 0 THEN balance END) AS ap,
  sum(total_amount) AS billed FROM fact_bill GROUP BY 1)"""),
    "open_bill_count": per_client("fact_bill", "balance > 0", open_count="count(*)"),
    "expenses_bills": per_client("fact_bill_line", bill=money("sum(amount)")),
    "expenses_purchases": per_client(
        "fact_purchase", "NOT is_credit", purchase=money("sum(total_amount)")),
    "total_expenses": flows(
        "kind IN ('bill', 'purchase')", bill=money(BILL), purchase=money(PUR),
        total_expenses=money(EXP)),
    "expenses_mtd": flows(f"{MONTH} AND kind IN ('bill', 'purchase')", expenses=money(EXP)),
    "expenses_ytd": flows(f"{YEAR} AND kind IN ('bill', 'purchase')", expenses=money(EXP)),
    "expense_ratio": flows("kind <> 'payment'", expense_ratio=ratio(EXP, REV, "0")),
    "net_income": flows(
        "kind <> 'payment'", net_income=money(f"coalesce({REV}, 0) - coalesce({EXP}, 0)")),
    "net_income_ytd": flows(
        f"{YEAR} AND kind <> 'payment'", revenue=money(REV), expenses=money(EXP),
        net_income=money(f"coalesce({REV}, 0) - coalesce({EXP}, 0)")),
    "net_margin": flows(
        "kind <> 'payment'",
        net_margin=ratio(f"(coalesce({REV}, 0) - coalesce({EXP}, 0))", REV, "0")),
    "gross_profit": COGS + f"""
SELECT client_id, {money('r')} AS total_revenue, {money('c')} AS cost_of_goods,
  {money('coalesce(r, 0) - coalesce(c, 0)')} AS gross_profit
FROM rev FULL JOIN cogs USING (client_id)""",
    "gross_margin": COGS + f"""
SELECT client_id, {ratio('coalesce(r, 0) - coalesce(c, 0)', 'r', '0')} AS gross_margin
FROM rev FULL JOIN cogs USING (client_id)""",
    "cash_inflow": per_client("fact_payment", cash_inflow=money("sum(total_amount)")),
    "cash_outflow": per_client(
        "fact_purchase", "NOT is_credit", cash_outflow=money("sum(total_amount)")),
    "net_cash_flow": flows(
        "kind IN ('payment', 'purchase')", cash_inflow=money(PAY), cash_outflow=money(PUR),
        net_cash_flow=money(f"coalesce({PAY}, 0) - coalesce({PUR}, 0)")),
    "cash_position": per_client(
        "dim_account", "account_type = 'Bank'", cash_position=money("sum(current_balance)")),
    "open_estimates": per_client(
        "fact_estimate",
        open_estimates=money("sum(total_amount) FILTER (WHERE linked_invoice_id IS NULL)")),
    "estimate_conversion": per_client(
        "fact_estimate", conversion_rate=ratio("count(linked_invoice_id)", "count(*)", "0")),
    "estimate_count": per_client("fact_estimate", estimate_count="count(*)"),
    "avg_estimate": per_client(
        "fact_estimate", average_estimate=mean("sum(total_amount)", "count(total_amount)")),
    "tax_total": per_client("fact_invoice", total_tax=money("sum(total_tax)")),
    "tax_ytd": per_client("fact_invoice", YEAR, tax_ytd=money("sum(total_tax)")),
}
