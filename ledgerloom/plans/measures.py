"""Business measures per tenant.

A model is any object with `table(name, *columns) -> DataFrame`. Measures on one fact share one
pass of conditional sums; callers select what they need and Catalyst drops the rest. Totals
from several facts are stacked as tagged movements and regrouped instead of being joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import blank
from ..functions.blank import blank_add, blank_sub, count_if, divide, mean, sum_if
from ..functions.dates import days_into_year, month, to_date_window
from ..operators import aging
from ..operators.merge import union
from ..operators.periods import with_prior
from .rollup import Rollup

TENANT = ["client_id"]
COST_OF_GOODS = "Cost of Goods Sold"
BANK = "Bank"


# -- line facts with their header's date ----------------------------------------------------

When = Callable[[Column], Column]  # a condition on a date


def dated_lines(
    model, line_table: str, header: str, key: str, *extra: str, when: When | None = None
) -> DataFrame:
    """Line amounts per document (and `extra` line columns) with the header date.

    Over all time, lines are summed per document before the join, so a document with very many
    lines reaches the join as one row; lines without a header keep a blank date. With a condition
    on the date, the headers that meet it come first and only their lines are kept and summed.
    """
    keys = ["client_id", key]
    lines = model.table(line_table, *keys, "amount", *extra)
    headers = model.table(header, *keys, "txn_date")
    if when is not None:
        headers = headers.where(when(F.col("txn_date")))
        return lines.join(headers, keys)
    return lines.groupBy(*keys, *extra).agg(F.sum("amount").alias("amount")).join(headers, keys, "left")


def paid_purchases(model, *wanted: str) -> DataFrame:
    """Purchases that are not credits; a missing flag counts as not a credit."""
    return model.table("fact_purchase", *wanted, "is_credit").where(
        ~F.coalesce("is_credit", F.lit(False))
    )


def movements(model, *kinds: str, dated: bool = True, when: When | None = None) -> DataFrame:
    """(client_id, kind, amount[, txn_date]) of revenue, bill, purchase and payment amounts, all
    or those whose date meets a condition."""
    date = ["txn_date"] if dated else []
    if isinstance(model, Rollup):
        held = model.amounts(*kinds)
        return (held if when is None else held.where(when(F.col("txn_date")))).select("client_id", "kind", "amount", *date)

    def lines(table, header, key):
        if dated:
            return dated_lines(model, table, header, key, when=when)
        return model.table(table, "client_id", "amount")

    def totals(df):
        chosen = df if when is None else df.where(when(F.col("txn_date")))
        return chosen.withColumnRenamed("total_amount", "amount")

    sources = {
        "revenue": lambda: lines("fact_invoice_line", "fact_invoice", "invoice_id"),
        "bill": lambda: lines("fact_bill_line", "fact_bill", "bill_id"),
        "purchase": lambda: totals(paid_purchases(model, "client_id", "total_amount", *date)),
        "payment": lambda: totals(
            model.table("fact_payment", "client_id", "total_amount", *date)
        ),
    }
    return union([
        sources[kind]().select("client_id", F.lit(kind).alias("kind"), "amount", *date)
        for kind in kinds
    ])


def of(*kinds: str) -> Column:
    return F.col("kind").isin(*kinds)


def totals(model, *kinds: str) -> DataFrame:
    """One column per kind and tenant; blank where a tenant has no such movement."""
    return movements(model, *kinds, dated=False).groupBy(*TENANT).agg(
        *(sum_if(of(kind), F.col("amount")).alias(kind) for kind in kinds)
    )


def expenses_of(df: DataFrame) -> Column:
    return blank_add(df["bill"], df["purchase"])


# -- revenue --------------------------------------------------------------------------------

def revenue(model) -> DataFrame:
    return movements(model, "revenue", dated=False).groupBy(*TENANT).agg(
        F.sum("amount").alias("total_revenue")
    )


def revenue_to_date(model, as_of) -> DataFrame:
    """Revenue of the current month, quarter and year up to `as_of`."""
    df = movements(model, "revenue", when=lambda d: to_date_window(d, as_of, "YEAR"))
    amount, date = F.col("amount"), F.col("txn_date")
    return df.groupBy(*TENANT).agg(
        sum_if(to_date_window(date, as_of, "MM"), amount).alias("revenue_mtd"),
        sum_if(to_date_window(date, as_of, "QUARTER"), amount).alias("revenue_qtd"),
        F.sum("amount").alias("revenue_ytd"),
    )


def revenue_in_period(model, as_of, grain: str) -> DataFrame:
    """Revenue to date in one period; only tenants with revenue in it appear."""
    return (
        movements(model, "revenue", when=lambda d: to_date_window(d, as_of, grain))
        .groupBy(*TENANT).agg(F.sum("amount").alias("revenue"))
    )


def monthly_revenue(model) -> DataFrame:
    return (
        movements(model, "revenue")
        .groupBy(*TENANT, month(F.col("txn_date")).alias("month"))
        .agg(F.sum("amount").alias("revenue"))
    )


def revenue_against(model, months: int) -> DataFrame:
    """Monthly revenue, the value `months` earlier, and the relative change."""
    df = with_prior(monthly_revenue(model), TENANT, "revenue", months)
    return df.withColumn("change", blank.change(df.revenue, df.prior))


def invoice_measures(model) -> DataFrame:
    if isinstance(model, Rollup):
        df = model.documents.where("kind = 'revenue' AND documents IS NOT NULL").groupBy(*TENANT).agg(
            F.sum("total_amount").alias("invoiced"), F.sum("documents").alias("invoice_count"),
            F.sum("total_tax").alias("total_tax"), F.sum("priced").alias("priced"),
        )
    else:
        df = model.table(
            "fact_invoice", "client_id", "customer_id", "total_amount", "total_tax"
        ).groupBy(*TENANT).agg(
            F.sum("total_amount").alias("invoiced"), F.count(F.lit(1)).alias("invoice_count"),
            F.sum("total_tax").alias("total_tax"), F.count("total_amount").alias("priced"),
        )
    return df.withColumn("average_invoice", mean(df.invoiced, df.priced))


def revenue_per_customer(model) -> DataFrame:
    if isinstance(model, Rollup):
        customers = model.distinct_customers()
    else:
        customers = model.table("fact_invoice", "client_id", "customer_id").groupBy(*TENANT).agg(
            blank.distinct_with_null(F.col("customer_id")).alias("customers")
        )
    df = revenue(model).join(customers, TENANT, "full")
    return df.select(
        "client_id", "total_revenue", "customers",
        divide(df.total_revenue, df.customers, 0).alias("revenue_per_customer"),
    )


# -- receivables and payables -----------------------------------------------------------------

def open_items(model, fact: str, *wanted: str) -> DataFrame:
    return model.table(fact, "client_id", "balance", *wanted).where("balance > 0")


def open_totals(model, fact: str) -> DataFrame:
    """Open balance and number of open documents per tenant."""
    return open_items(model, fact).groupBy(*TENANT).agg(
        F.sum("balance").alias("total_open"), F.count(F.lit(1)).alias("open_count")
    )


def receivable_aging(model, as_of, *by: str) -> DataFrame:
    df = model.table("fact_invoice", "client_id", "balance", "due_date", *by)
    return aging.aging(df, [*TENANT, *by], as_of, aging.RECEIVABLE_EDGES)


def payable_aging(model, as_of, *by: str) -> DataFrame:
    df = model.table("fact_bill", "client_id", "balance", "due_date", *by)
    return aging.aging(df, [*TENANT, *by], as_of, aging.PAYABLE_EDGES)


def days_outstanding(open_amount: Column, basis: Column, days: Column) -> Column:
    """Open amount over the daily amount `basis / days`; blank unless the daily amount is
    positive, hence blank on the first day of a year."""
    daily = F.when(days != 0, basis.cast("double") / F.when(days != 0, days))
    return F.when(daily > 0, F.round(open_amount.cast("double") / daily, 6))


def days_sales_outstanding(model, as_of) -> DataFrame:
    df = open_totals(model, "fact_invoice").join(
        revenue_in_period(model, as_of, "YEAR"), TENANT, "full"
    )
    return df.select(
        "client_id", F.col("total_open").alias("ar_total"), F.col("revenue").alias("revenue_ytd"),
        days_outstanding(df.total_open, df.revenue, days_into_year(as_of)).alias("dso"),
    )


def days_payable_outstanding(model, as_of) -> DataFrame:
    """The daily amount is the all-time billed total over the days of the current year."""
    df = model.table("fact_bill", "client_id", "balance", "total_amount").groupBy(*TENANT).agg(
        sum_if(F.col("balance") > 0, F.col("balance")).alias("ap_total"),
        F.sum("total_amount").alias("billed"),
    )
    dpo = days_outstanding(df.ap_total, df.billed, days_into_year(as_of))
    return df.withColumn("dpo", dpo)


def collection_rate(model) -> DataFrame:
    df = totals(model, "payment", "revenue")
    return df.withColumn("collection_rate", divide(df.payment, df.revenue, 0))


# -- expenses and profit ------------------------------------------------------------------------

def expenses(model) -> DataFrame:
    df = totals(model, "bill", "purchase")
    return df.withColumn("total_expenses", expenses_of(df))


def expenses_to_date(model, as_of, grain: str) -> DataFrame:
    df = (
        movements(model, "bill", "purchase", when=lambda d: to_date_window(d, as_of, grain))
        .groupBy(*TENANT)
        .agg(F.sum("amount").alias("expenses"))
    )
    return df


def profit(model) -> DataFrame:
    """Revenue, expenses, their ratio, net income and net margin."""
    df = totals(model, "revenue", "bill", "purchase")
    df = df.withColumn("total_expenses", expenses_of(df))
    df = df.withColumn("net_income", blank_sub(df.revenue, df.total_expenses))
    return df.select(
        "client_id", F.col("revenue").alias("total_revenue"), "total_expenses", "net_income",
        divide(df.total_expenses, df.revenue, 0).alias("expense_ratio"),
        divide(df.net_income, df.revenue, 0).alias("net_margin"),
    )


def net_income_to_date(model, as_of, grain: str = "YEAR") -> DataFrame:
    df = (
        movements(
            model, "revenue", "bill", "purchase", when=lambda d: to_date_window(d, as_of, grain))
        .groupBy(*TENANT)
        .agg(
            sum_if(of("revenue"), F.col("amount")).alias("revenue"),
            sum_if(of("bill", "purchase"), F.col("amount")).alias("expenses"),
        )
    )
    return df.withColumn("net_income", blank_sub(df.revenue, df.expenses))


def cost_of_goods(model) -> DataFrame:
    """Bill lines booked to cost accounts, summed per account before the account join."""
    if isinstance(model, Rollup):
        lines = model.activity.where("kind = 'bill'")
    else:
        lines = model.table("fact_bill_line", "client_id", "account_id", "amount")
    spent = lines.groupBy("client_id", "account_id").agg(F.sum("amount").alias("amount"))
    accounts = model.table("dim_account", "client_id", "account_id", "account_type").where(
        F.col("account_type") == COST_OF_GOODS
    )
    return spent.join(accounts, ["client_id", "account_id"]).groupBy(*TENANT).agg(
        F.sum("amount").alias("cost_of_goods")
    )


def gross_profit(model) -> DataFrame:
    df = revenue(model).join(cost_of_goods(model), TENANT, "full")
    df = df.withColumn("gross_profit", blank_sub(df.total_revenue, df.cost_of_goods))
    return df.withColumn("gross_margin", divide(df.gross_profit, df.total_revenue, 0))


# -- cash, estimates, tax -------------------------------------------------------------------------

def cash_flow(model) -> DataFrame:
    df = totals(model, "payment", "purchase")
    return df.select(
        "client_id", F.col("payment").alias("cash_inflow"),
        F.col("purchase").alias("cash_outflow"),
        blank_sub(df.payment, df.purchase).alias("net_cash_flow"),
    )


def cash_position(model) -> DataFrame:
    return (
        model.table("dim_account", "client_id", "account_type", "current_balance")
        .where(F.col("account_type") == BANK)
        .groupBy(*TENANT).agg(F.sum("current_balance").alias("cash_position"))
    )


def estimates(model) -> DataFrame:
    linked = F.col("linked_invoice_id").isNotNull()
    df = model.table(
        "fact_estimate", "client_id", "total_amount", "linked_invoice_id"
    ).groupBy(*TENANT).agg(
        sum_if(~linked, F.col("total_amount")).alias("open_estimates"),
        count_if(linked).alias("converted"), F.count(F.lit(1)).alias("estimate_count"),
        F.sum("total_amount").alias("estimated"), F.count("total_amount").alias("priced"),
    )
    return df.select(
        "client_id", "open_estimates", "estimate_count",
        divide(df.converted, df.estimate_count, 0).alias("conversion_rate"),
        mean(df.estimated, df.priced).alias("average_estimate"),
    )


def tax_to_date(model, as_of) -> DataFrame:
    return (
        model.table("fact_invoice", "client_id", "txn_date", "total_tax")
        .where(to_date_window(F.col("txn_date"), as_of, "YEAR"))
        .groupBy(*TENANT).agg(F.sum("total_tax").alias("tax_ytd"))
    )
