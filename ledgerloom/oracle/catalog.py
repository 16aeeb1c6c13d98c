"""All expected results by query name."""

from .loads import LOADS
from .measures import CHANGE, MEASURES, PAIR, against
from .reports import REPORTS
from .star import star

# The same results, from a loaded warehouse instead of the derived tables.
WAREHOUSE = {
    "wh_exec_summary": REPORTS["v_exec_summary"], "wh_pnl_matrix": REPORTS["v_pnl_matrix"],
    "wh_ar_aging": REPORTS["v_ar_aging_customer"],
}

# Measures that the stored aggregates answer: value column by query name.
ROLLED = {
    "total_revenue": "total_revenue", "revenue_mtd": "revenue", "revenue_qtd": "revenue", "revenue_ytd": "revenue",
    "avg_invoice": "average_invoice", "invoice_count": "invoice_count", "revenue_per_customer": "revenue_per_customer",
    "expenses_bills": "bill", "expenses_purchases": "purchase", "total_expenses": "total_expenses",
    "expenses_mtd": "expenses", "expenses_ytd": "expenses", "expense_ratio": "expense_ratio", "net_income": "net_income",
    "net_income_ytd": "net_income", "net_margin": "net_margin",
}

# The same results, from stored partial aggregates instead of the facts.
ROLLUPS = {
    "rollup_measures": " UNION ALL ".join(
        f"SELECT client_id, '{key}' AS measure, CAST({value} AS DOUBLE) AS value FROM ({MEASURES[key]})" for key, value in ROLLED.items()),
    "rollup_customers": star("""
, g AS (SELECT client_id, customer_id, txn_date, unnest(['month', 'quarter', 'year']) AS grain FROM fact_invoice)
SELECT client_id, grain, CAST(date_trunc(grain, txn_date) AS DATE) AS period, count(DISTINCT customer_id) AS customers
FROM g GROUP BY ALL"""),
    "rollup_revenue_mom": against(1, f"{PAIR}, {CHANGE}"),
    "rollup_revenue_yoy": against(12, f"{PAIR}, {CHANGE}"),
    **{f"rollup_{name}": REPORTS[f"v_{name}"] for name in (
        "rev_exp_12m", "revenue_by_item", "customer_ranking", "pnl_matrix", "pnl_waterfall", "pnl_grains")},
}

ORACLE: dict[str, str] = {**LOADS, **MEASURES, **REPORTS, **WAREHOUSE, **ROLLUPS}
