"""Registered queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .loads import LOADS
from .operators.merge import union
from .plans import measures as m, reports as r, rollup
from .sources.star import AS_OF, PartAccounts, StarTables, StoredStar

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Boundary types: money and quantities as DOUBLE, integers as BIGINT."""
    def shape(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("bigint").alias(field.name)
        return column
    return df.select(*map(shape, df.schema.fields))


def over_star(build: Callable[[StarTables], DataFrame], *keep: str) -> Query:
    """A query over the star tables of a folder, projected to `keep` when given."""
    def run(spark: SparkSession, path: str) -> DataFrame:
        df = build(StarTables(spark, path))
        return present(df.select(*keep) if keep else df)
    return run


MEASURES: dict[str, Query] = {
    "total_revenue": over_star(m.revenue),
    "revenue_mtd": over_star(lambda s: m.revenue_in_period(s, AS_OF, "MM")),
    "revenue_qtd": over_star(lambda s: m.revenue_in_period(s, AS_OF, "QUARTER")),
    "revenue_ytd": over_star(lambda s: m.revenue_in_period(s, AS_OF, "YEAR")),
    "revenue_to_date": over_star(lambda s: m.revenue_to_date(s, AS_OF)),
    "revenue_prior_month": over_star(
        lambda s: m.revenue_against(s, 1), "client_id", "month", "revenue", "prior"),
    "revenue_mom": over_star(lambda s: m.revenue_against(s, 1), "client_id", "month", "change"),
    "revenue_prior_year": over_star(
        lambda s: m.revenue_against(s, 12), "client_id", "month", "revenue", "prior"),
    "revenue_yoy": over_star(lambda s: m.revenue_against(s, 12), "client_id", "month", "change"),
    "avg_invoice": over_star(m.invoice_measures, "client_id", "average_invoice"),
    "invoice_count": over_star(m.invoice_measures, "client_id", "invoice_count"),
    "revenue_per_customer": over_star(m.revenue_per_customer),
    "ar_total": over_star(lambda s: m.open_totals(s, "fact_invoice"), "client_id", "total_open"),
    "ar_buckets": over_star(lambda s: m.receivable_aging(s, AS_OF)),
    "dso": over_star(lambda s: m.days_sales_outstanding(s, AS_OF)),
    "open_invoice_count": over_star(
        lambda s: m.open_totals(s, "fact_invoice"), "client_id", "open_count"),
    "collection_rate": over_star(m.collection_rate),
    "ap_total": over_star(lambda s: m.open_totals(s, "fact_bill"), "client_id", "total_open"),
    "ap_buckets": over_star(lambda s: m.payable_aging(s, AS_OF)),
    "dpo": over_star(lambda s: m.days_payable_outstanding(s, AS_OF)),
    "open_bill_count": over_star(
        lambda s: m.open_totals(s, "fact_bill"), "client_id", "open_count"),
    "expenses_bills": over_star(lambda s: m.totals(s, "bill")),
    "expenses_purchases": over_star(lambda s: m.totals(s, "purchase")),
    "total_expenses": over_star(m.expenses),
    "expenses_mtd": over_star(lambda s: m.expenses_to_date(s, AS_OF, "MM")),
    "expenses_ytd": over_star(lambda s: m.expenses_to_date(s, AS_OF, "YEAR")),
    "expense_ratio": over_star(m.profit, "client_id", "expense_ratio"),
    "net_income": over_star(m.profit, "client_id", "net_income"),
    "net_income_ytd": over_star(lambda s: m.net_income_to_date(s, AS_OF)),
    "net_margin": over_star(m.profit, "client_id", "net_margin"),
    "gross_profit": over_star(
        m.gross_profit, "client_id", "total_revenue", "cost_of_goods", "gross_profit"),
    "gross_margin": over_star(m.gross_profit, "client_id", "gross_margin"),
    "cash_inflow": over_star(m.cash_flow, "client_id", "cash_inflow"),
    "cash_outflow": over_star(m.cash_flow, "client_id", "cash_outflow"),
    "net_cash_flow": over_star(m.cash_flow),
    "cash_position": over_star(m.cash_position),
    "open_estimates": over_star(m.estimates, "client_id", "open_estimates"),
    "estimate_conversion": over_star(m.estimates, "client_id", "conversion_rate"),
    "estimate_count": over_star(m.estimates, "client_id", "estimate_count"),
    "avg_estimate": over_star(m.estimates, "client_id", "average_estimate"),
    "tax_total": over_star(m.invoice_measures, "client_id", "total_tax"),
    "tax_ytd": over_star(lambda s: m.tax_to_date(s, AS_OF)),
}

REPORTS: dict[str, Query] = {
    "v_rev_exp_12m": over_star(lambda s: r.revenue_and_expenses(s, AS_OF)),
    "v_revenue_by_item": over_star(r.revenue_by_item_type),
    "v_top_customers": over_star(r.top_customers),
    "v_exec_summary": over_star(lambda s: r.summary_cards(s, AS_OF)),
    "v_pnl_matrix": over_star(r.pnl_matrix),
    "v_pnl_hierarchy": over_star(r.pnl_hierarchy),
    "v_item_hierarchy": over_star(lambda s: r.pnl_hierarchy(PartAccounts(s), "revenue")),
    "v_pnl_waterfall": over_star(r.pnl_waterfall),
    "v_pnl_grains": over_star(r.pnl_by_grain),
    "v_balance_sheet": over_star(r.balance_sheet),
    "v_balance_check": over_star(r.balance_check),
    "v_trial_balance": over_star(r.trial_balance),
    "v_account_tree": over_star(r.account_tree),
    "v_customer_tree": over_star(r.halved_customer_tree),
    "v_cash_walk": over_star(r.cash_walk),
    "v_cash_trend": over_star(lambda s: r.cash_trend(s, AS_OF)),
    "v_cash_trend_weekly": over_star(lambda s: r.cash_trend(s, AS_OF, "WEEK")),
    "v_cash_by_party": over_star(r.cash_by_party),
    "v_ar_aging_customer": over_star(lambda s: r.receivable_aging_by_customer(s, AS_OF)),
    "v_ap_aging_vendor": over_star(lambda s: r.payable_aging_by_vendor(s, AS_OF)),
    "v_open_invoices": over_star(lambda s: r.open_invoices(s, AS_OF)),
    "v_open_bills": over_star(lambda s: r.open_bills(s, AS_OF)),
    "v_balance_as_of": over_star(lambda s: r.balance_as_of(s, r.month_ends_of(s, AS_OF))),
    "v_dso_history": over_star(lambda s: r.dso_history(s, AS_OF)),
    "v_dso_trend": over_star(lambda s: r.dso_trend(s, AS_OF)),
    "v_dpo_trend": over_star(lambda s: r.dpo_trend(s, AS_OF)),
    "v_ap_by_category": over_star(r.payables_by_category),
    "v_revenue_cumulative": over_star(r.revenue_cumulative),
    "v_top_categories": over_star(r.top_categories),
    "v_customer_ranking": over_star(r.customer_ranking),
    "v_customer_trend": over_star(lambda s: r.customer_trend(s, AS_OF)),
    "v_expense_by_type": over_star(r.expense_by_type),
    "v_largest_expense": over_star(r.largest_expense),
    "v_expense_yoy": over_star(r.expense_against_prior_year),
    "v_expense_mix": over_star(r.expense_mix),
    "v_top_vendors": over_star(lambda s: r.top_vendors(s, AS_OF)),
    "v_vendor_share": over_star(r.vendor_share),
    "v_reconcile": over_star(r.reconcile),
}

# Scalar measures per tenant that the stored aggregates answer: registered key and value column.
ROLLED = {
    "total_revenue": "total_revenue", "revenue_mtd": "revenue", "revenue_qtd": "revenue", "revenue_ytd": "revenue",
    "avg_invoice": "average_invoice", "invoice_count": "invoice_count", "revenue_per_customer": "revenue_per_customer",
    "expenses_bills": "bill", "expenses_purchases": "purchase", "total_expenses": "total_expenses",
    "expenses_mtd": "expenses", "expenses_ytd": "expenses", "expense_ratio": "expense_ratio", "net_income": "net_income",
    "net_income_ytd": "net_income", "net_margin": "net_margin",
}


def rolled_measures(held: rollup.Rollup) -> DataFrame:
    """The measures of ROLLED in long form, all from one set of aggregates."""
    of_key = {
        "total_revenue": m.revenue(held),
        **{f"revenue_{n}": m.revenue_in_period(held, AS_OF, g) for n, g in (("mtd", "MM"), ("qtd", "QUARTER"), ("ytd", "YEAR"))},
        **dict.fromkeys(("avg_invoice", "invoice_count"), m.invoice_measures(held)),
        "revenue_per_customer": m.revenue_per_customer(held),
        "expenses_bills": m.totals(held, "bill"), "expenses_purchases": m.totals(held, "purchase"), "total_expenses": m.expenses(held),
        "expenses_mtd": m.expenses_to_date(held, AS_OF, "MM"), "expenses_ytd": m.expenses_to_date(held, AS_OF, "YEAR"),
        **dict.fromkeys(("expense_ratio", "net_income", "net_margin"), m.profit(held)),
        "net_income_ytd": m.net_income_to_date(held, AS_OF),
    }
    return union([
        of_key[key].select("client_id", F.lit(key).alias("measure"), F.col(value).cast("double").alias("value")) for key, value in ROLLED.items()])


def over_rollup(build: Callable[[rollup.Rollup], DataFrame]) -> Query:
    """A query over the stored aggregates of the star tables of a folder."""
    return over_star(lambda star: build(rollup.build(StoredStar(star.spark, star.path, details=False))))


ROLLUPS: dict[str, Query] = {
    "rollup_measures": over_rollup(rolled_measures),
    "rollup_customers": over_rollup(rollup.customers_by_grain),
    "rollup_revenue_mom": over_rollup(lambda h: m.revenue_against(h, 1)),
    "rollup_revenue_yoy": over_rollup(lambda h: m.revenue_against(h, 12)),
    "rollup_rev_exp_12m": over_rollup(lambda h: r.revenue_and_expenses(h, AS_OF)),
    "rollup_revenue_by_item": over_rollup(r.revenue_by_item_type),
    "rollup_customer_ranking": over_rollup(r.customer_ranking),
    "rollup_pnl_matrix": over_rollup(r.pnl_matrix),
    "rollup_pnl_waterfall": over_rollup(r.pnl_waterfall),
    "rollup_pnl_grains": over_rollup(r.pnl_by_grain),
}

QUERIES: dict[str, Query] = {
    **{name: over_star(build) for name, build in LOADS.items()}, **MEASURES, **REPORTS, **ROLLUPS,
}
