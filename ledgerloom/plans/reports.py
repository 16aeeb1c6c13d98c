"""Dashboard reports: executive, profit and loss, balance sheet, cash, aging, revenue, expense.

Every report covers all tenants. Rankings and running totals work on data already reduced to
categories, months or days per tenant; rankings of customers and vendors use group limits or
the sliced rank, so that one large tenant is never sorted by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import blank
from ..functions.blank import blank_add, blank_sub, divide, mean, sum_if
from ..functions.dates import day, days_late, month
from ..operators import aging, history
from ..operators.apportion import apportioned, cents
from ..operators.hierarchy import hierarchy, rolled_up
from ..operators.merge import union
from ..operators.periods import with_prior
from ..operators.ranking import rank_within, top_n
from . import measures as m
from .measures import TENANT, dated_lines, movements, of, paid_purchases
from .rollup import Rollup


# Account types that are current assets.
CURRENT_ASSETS = ("Bank", "Accounts Receivable", "Other Current Asset")
# Label of lines whose account is missing or unknown.
UNASSIGNED = "Unassigned"


def named(df: DataFrame, model, dim: str, key: str, *names: str) -> DataFrame:
    """Adds descriptive columns of a dimension; facts without a match keep blank names."""
    return df.join(model.table(dim, "client_id", key, *names), ["client_id", key], "left")


def trailing_year(date, as_of):
    """The twelve calendar months that end with the month of `as_of`."""
    first = F.add_months(F.trunc(day(as_of), "MM"), -11)
    return (date >= first) & (date <= F.last_day(day(as_of)))


# -- executive summary ------------------------------------------------------------------------

def revenue_and_expenses(model, as_of) -> DataFrame:
    """Monthly revenue and expenses over the trailing twelve months."""
    return (
        movements(model, "revenue", "bill", "purchase", when=lambda d: trailing_year(d, as_of))
        .groupBy(*TENANT, month(F.col("txn_date")).alias("month"))
        .agg(
            sum_if(of("revenue"), F.col("amount")).alias("revenue"),
            sum_if(of("bill", "purchase"), F.col("amount")).alias("expenses"),
        )
    )


def revenue_by_item_type(model) -> DataFrame:
    """Revenue per item category; lines are summed per item before the item join."""
    if isinstance(model, Rollup):
        lines = model.activity.where("kind = 'revenue'")
    else:
        lines = model.table("fact_invoice_line", "client_id", "item_id", "amount")
    items = lines.groupBy("client_id", "item_id").agg(F.sum("amount").alias("amount"))
    return named(items, model, "dim_item", "item_id", "item_type").groupBy(
        *TENANT, "item_type"
    ).agg(F.sum("amount").alias("revenue"))


def customer_revenue(model) -> DataFrame:
    """Revenue and invoice count per customer, from invoices that have lines. Lines without a
    header count under a blank customer."""
    if isinstance(model, Rollup):
        revenue = model.activity.where("kind = 'revenue'").select(
            "client_id", "party_id", F.col("amount").alias("revenue"), F.lit(None).cast("long").alias("invoice_count"))
        counts = model.documents.where("kind = 'revenue' AND with_lines IS NOT NULL").select(
            "client_id", "party_id", F.lit(None).cast("decimal(18,2)").alias("revenue"), F.col("with_lines").alias("invoice_count"))
        return revenue.unionByName(counts).groupBy(*TENANT, F.col("party_id").alias("customer_id")).agg(
            F.sum("revenue").alias("revenue"), F.sum("invoice_count").alias("invoice_count"))
    lines = (
        model.table("fact_invoice_line", "client_id", "invoice_id", "amount")
        .groupBy("client_id", "invoice_id").agg(F.sum("amount").alias("amount"))
    )
    invoices = model.table("fact_invoice", "client_id", "invoice_id", "customer_id")
    return (
        lines.join(invoices, ["client_id", "invoice_id"], "left")
        .groupBy(*TENANT, "customer_id")
        .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("invoice_count"))
    )


def top_customers(model, n: int = 5) -> DataFrame:
    best = top_n(
        customer_revenue(model).drop("invoice_count"), TENANT,
        [F.desc("revenue"), F.asc("customer_id")], n,
    )
    return named(best, model, "dim_customer", "customer_id", "display_name")


def summary_cards(model, as_of) -> DataFrame:
    """The cards of the executive page, one row per tenant, registered or not."""
    parts = [
        m.net_income_to_date(model, as_of).select(
            *TENANT, F.col("revenue").alias("revenue_ytd"),
            F.col("net_income").alias("net_income_ytd")),
        m.days_sales_outstanding(model, as_of).select(*TENANT, "ar_total", "dso"),
        m.cash_position(model),
        m.gross_profit(model).select(*TENANT, "gross_margin"),
    ]
    df = model.table("dim_client", "client_id")
    for part in parts:
        df = df.join(part, TENANT, "full")
    return df


# -- profit and loss --------------------------------------------------------------------------

def account_activity(model, *kinds: str) -> DataFrame:
    """(client_id, account_id, txn_date, amount) of income and expense lines; those without a header
    have a blank date."""
    if isinstance(model, Rollup):
        return model.activity.where(of(*kinds)).select("client_id", "account_id", "txn_date", "amount")
    sources = {
        "revenue": lambda: dated_lines(
            model, "fact_invoice_line", "fact_invoice", "invoice_id", "account_id"),
        "bill": lambda: dated_lines(
            model, "fact_bill_line", "fact_bill", "bill_id", "account_id"),
        "purchase": lambda: (
            model.table("fact_purchase_line", "client_id", "purchase_id", "account_id", "amount")
            .groupBy("client_id", "purchase_id", "account_id")
            .agg(F.sum("amount").alias("amount"))
            .join(
                model.table("fact_purchase", "client_id", "purchase_id", "txn_date", "is_credit"),
                ["client_id", "purchase_id"], "left",
            ).where(~F.coalesce("is_credit", F.lit(False)))
        ),
    }
    return union([
        sources[kind]().select("client_id", "account_id", "txn_date", "amount") for kind in kinds
    ])


def account_months(model, *kinds: str) -> DataFrame:
    return (
        account_activity(model, *kinds)
        .groupBy(*TENANT, "account_id", month(F.col("txn_date")).alias("month"))
        .agg(F.sum("amount").alias("amount"))
    )


def pnl_matrix(model) -> DataFrame:
    """Income and expense lines by account and month in long form, with a subtotal per
    classification (account blank) and a total per classification over all months (month blank
    too); `level` tells them from lines without a date. Lines without a known account form a group of their own, so no amount is lost."""
    df = named(
        account_months(model, "revenue", "bill", "purchase"), model, "dim_account",
        "account_id", "classification", "fully_qualified_name",
    ).withColumns({
        "classification": F.coalesce("classification", F.lit(UNASSIGNED)),
        "fully_qualified_name": F.coalesce("fully_qualified_name", "account_id", F.lit(UNASSIGNED)),
    })
    keys = [F.col(c) for c in ("client_id", "classification", "month", "fully_qualified_name")]
    level = F.when(F.grouping("month") == 1, "total").when(
        F.grouping("fully_qualified_name") == 1, "month").otherwise("account")
    return df.groupingSets([keys, keys[:3], keys[:2]], *keys).agg(
        level.alias("level"), F.sum("amount").alias("amount")
    )


def pnl_wide(model, months: list) -> DataFrame:
    """The matrix with one column per given month."""
    cells = pnl_matrix(model).where(F.col("month").isin(months))
    return cells.groupBy("client_id", "classification", "fully_qualified_name").pivot(
        "month", months
    ).agg(F.first("amount"))


def pnl_hierarchy(model, *kinds: str) -> DataFrame:
    """Income and expense lines by account and month along the account tree, all accounts below one
    included: an account's total is its own amount plus its children's totals. Accounts without a
    known place in the tree are under "Unassigned"; the totals of the roots add up to all lines."""
    months = account_months(model, *(kinds or ("revenue", "bill", "purchase")))
    accounts = model.table("dim_account", "client_id", "account_id", "parent_account_id")
    rows = rolled_up(months, accounts, "account_id", "parent_account_id", UNASSIGNED, "month")
    return named(rows, model, "dim_account", "account_id", "account_name", "classification")


def pnl_waterfall(model) -> DataFrame:
    """Revenue, cost of goods, gross profit, operating expenses and net income as ordered steps."""
    df = m.profit(model).join(m.cost_of_goods(model), TENANT, "full")
    df = df.withColumns({
        "gross_profit": blank_sub(df.total_revenue, df.cost_of_goods),
        "operating": blank_sub(df.total_expenses, df.cost_of_goods),
    })
    steps = [
        ("Revenue", df.total_revenue), ("Cost of Goods Sold", -df.cost_of_goods),
        ("Gross Profit", F.col("gross_profit")), ("Operating Expenses", -F.col("operating")),
        ("Net Income", df.net_income),
    ]
    return df.select("client_id", F.inline(F.array(*(
        F.struct(
            F.lit(i).alias("step"), F.lit(label).alias("label"),
            amount.cast("decimal(38,2)").alias("amount"),
        )
        for i, (label, amount) in enumerate(steps, 1)
    ))))


def pnl_by_grain(model) -> DataFrame:
    """Revenue, expenses and net by month, quarter and year from one monthly series."""
    monthly = (
        movements(model, "revenue", "bill", "purchase")
        .groupBy(*TENANT, month(F.col("txn_date")).alias("month"))
        .agg(
            sum_if(of("revenue"), F.col("amount")).alias("revenue"),
            sum_if(of("bill", "purchase"), F.col("amount")).alias("expenses"),
        )
    )
    spread = monthly.select(
        "client_id", "revenue", "expenses",
        F.inline(F.array(
            F.struct(F.lit("month").alias("grain"), F.col("month").alias("period")),
            F.struct(F.lit("quarter").alias("grain"), F.trunc("month", "QUARTER").alias("period")),
            F.struct(F.lit("year").alias("grain"), F.trunc("month", "YEAR").alias("period")),
        )),
    )
    df = spread.groupBy(*TENANT, "grain", "period").agg(
        F.sum("revenue").alias("revenue"), F.sum("expenses").alias("expenses")
    )
    return df.withColumn("net_income", blank_sub(df.revenue, df.expenses))


# -- balance sheet ------------------------------------------------------------------------------

def balance_sheet(model) -> DataFrame:
    """Balances by classification, section and account type, with a subtotal per section and per
    classification and the total of liabilities and equity; `level` names the kind of row."""
    accounts = model.table(
        "dim_account", "client_id", "classification", "account_type", "current_balance"
    ).where(F.col("classification").isin("Asset", "Liability", "Equity"))
    kind = F.coalesce("account_type", F.lit(UNASSIGNED))
    section = F.when(F.col("classification") == "Asset", F.when(
        kind.isin(*CURRENT_ASSETS), "Current Assets").when(
        kind == "Fixed Asset", "Fixed Assets").otherwise("Other Assets"))
    section = F.when(F.col("classification") == "Liability", F.when(
        kind == "Long Term Liability", "Long-Term Liabilities").otherwise(
        "Current Liabilities")).when(F.col("classification") == "Equity", "Equity").otherwise(section)
    rows = accounts.withColumns({"section": section, "account_type": kind})
    keys = [F.col(c) for c in ("client_id", "classification", "section", "account_type")]
    level = F.when(F.grouping("section") == 1, "classification").when(
        F.grouping("account_type") == 1, "section").otherwise("account type")
    sheet = rows.groupingSets([keys, keys[:3], keys[:2]], *keys).agg(
        level.alias("level"), F.sum("current_balance").alias("balance"))
    none = F.lit(None).cast("string")
    closing = accounts.where("classification <> 'Asset'").groupBy("client_id").agg(
        F.sum("current_balance").alias("balance")
    ).withColumns({
        "classification": F.lit("Liabilities and Equity"), "section": none, "account_type": none,
        "level": F.lit("total")})
    return sheet.unionByName(closing)


def balance_check(model) -> DataFrame:
    """Assets against liabilities plus equity."""
    balance, group = F.col("current_balance"), F.col("classification")
    df = model.table("dim_account", "client_id", "classification", "current_balance").groupBy(
        *TENANT
    ).agg(
        sum_if(group == "Asset", balance).alias("assets"),
        sum_if(group == "Liability", balance).alias("liabilities"),
        sum_if(group == "Equity", balance).alias("equity"),
    )
    gap = blank_sub(df.assets, blank_add(df.liabilities, df.equity))
    return df.withColumns({"difference": gap, "balanced": F.coalesce(gap, F.lit(0)) == 0})


def trial_balance(model) -> DataFrame:
    """Accounts with their balance on the debit or credit side.

    Assets and expenses are debits when positive, the other classes credits when positive.
    """
    accounts = model.table(
        "dim_account", "client_id", "account_id", "account_name", "classification",
        "current_balance",
    )
    side = F.when(F.col("classification").isin("Asset", "Expense"), 1).otherwise(-1)
    signed = F.col("current_balance") * side
    return accounts.select(
        "client_id", "account_id", "account_name", "classification",
        F.greatest(signed, F.lit(0)).cast("decimal(18,2)").alias("debit"),
        F.greatest(-signed, F.lit(0)).cast("decimal(18,2)").alias("credit"),
    )


def account_tree(model) -> DataFrame:
    """Every account with its depth, root and path."""
    accounts = model.table("dim_account", "client_id", "account_id", "parent_account_id")
    return hierarchy(accounts, "account_id", "parent_account_id")


def halved_customer_tree(model) -> DataFrame:
    """The customer tree of a model without parents: a customer belongs to the one with half its
    number, if its tenant has that one."""
    number = F.col("customer_id").cast("bigint")
    parent = F.when(number > 0, F.floor(number / 2).cast("string"))
    customers = model.table("dim_customer", "client_id", "customer_id").withColumn("parent_customer_id", parent)
    return hierarchy(customers, "customer_id", "parent_customer_id")


def customer_tree(model) -> DataFrame:
    """Every customer or job with its depth, root and path."""
    customers = model.table("dim_customer", "client_id", "customer_id", "parent_customer_id")
    return hierarchy(customers, "customer_id", "parent_customer_id")


# -- cash ---------------------------------------------------------------------------------------

def cash_walk(model) -> DataFrame:
    """Opening, in, out and closing cash; closing is the bank position, opening follows."""
    df = m.cash_flow(model).join(m.cash_position(model), TENANT, "full")
    return df.select(
        "client_id", blank_sub(df.cash_position, df.net_cash_flow).alias("opening"),
        F.col("cash_inflow").alias("cash_in"), F.col("cash_outflow").alias("cash_out"),
        F.col("cash_position").alias("closing"),
    )


def cash_trend(model, as_of, grain: str = "DAY") -> DataFrame:
    """Net cash of every day or week, its running total and the balance at its end.

    Periods without movements are there too, up to `as_of` or the last movement, whichever is later;
    there the balance is the bank position, and it is carried backwards from it. Movements without a
    date are in a row of their own, before all others.
    """
    period = F.col("txn_date") if grain == "DAY" else F.trunc("txn_date", grain)
    flow = F.when(of("payment"), F.col("amount")).otherwise(-F.col("amount"))
    moved = (
        movements(model, "payment", "purchase")
        .groupBy(*TENANT, period.alias("period")).agg(F.sum(flow).alias("net_flow"))
    )
    position = m.cash_position(model)
    whole = moved.groupBy(*TENANT).agg(F.sum("net_flow").alias("_all"))
    dense = history.every_period(moved, TENANT, "period", ["net_flow"], grain, day(as_of), position)
    df = history.running_sum(dense, TENANT, "period", "net_flow", "running_cash")
    df = df.join(position, TENANT, "left").join(whole, TENANT, "left")
    later = F.coalesce("_all", F.lit(0)) - F.col("running_cash")
    return df.select(*TENANT, "period", "net_flow", "running_cash", (F.col("cash_position") - later).alias("balance"))


def cash_by_party(model) -> DataFrame:
    """Inflow per customer and outflow per expense account type. The outflow adds up to the purchases:
    what their lines lack, or have too much, is "Unassigned", as are lines without a known account."""
    paid = model.table("fact_payment", "client_id", "customer_id", "total_amount").groupBy(
        "client_id", "customer_id"
    ).agg(F.sum("total_amount").alias("amount"))
    inflow = named(paid, model, "dim_customer", "customer_id", "display_name").select(
        "client_id", F.lit("in").alias("direction"), F.col("customer_id").alias("party_id"),
        F.col("display_name").alias("party"), "amount",
    )
    key = ["client_id", "purchase_id"]
    lines = model.table("fact_purchase_line", *key, "account_id", "amount").groupBy(*key, "account_id").agg(
        F.sum("amount").alias("amount"))
    purchases = paid_purchases(model, *key, "total_amount")
    booked = lines.join(purchases.select(*key), key).select(*key, "account_id", "amount")
    # per purchase, its total less its lines; a total of zero for one without a header cannot occur here
    rest = purchases.select(*key, F.col("total_amount").alias("amount")).unionByName(
        booked.select(*key, (-F.col("amount")).alias("amount"))).groupBy(*key).agg(F.sum("amount").alias("amount")).where("amount <> 0")
    spent = booked.drop("purchase_id").unionByName(
        rest.select("client_id", F.lit(None).cast("string").alias("account_id"), "amount"))
    sums = spent.groupBy("client_id", "account_id").agg(F.sum("amount").alias("amount"))
    outflow = (
        named(sums, model, "dim_account", "account_id", "account_type")
        .groupBy("client_id", F.coalesce("account_type", F.lit(UNASSIGNED)).alias("party")).agg(F.sum("amount").alias("amount"))
        .select("client_id", F.lit("out").alias("direction"), F.lit(None).cast("string").alias("party_id"), "party", "amount")
    )
    return inflow.unionByName(outflow)


# -- receivables and payables -------------------------------------------------------------------

def receivable_aging_by_customer(model, as_of) -> DataFrame:
    df = m.receivable_aging(model, as_of, "customer_id")
    return named(df, model, "dim_customer", "customer_id", "display_name")


def payable_aging_by_vendor(model, as_of) -> DataFrame:
    df = m.payable_aging(model, as_of, "vendor_id")
    return named(df, model, "dim_vendor", "vendor_id", "display_name")


def open_invoices(model, as_of) -> DataFrame:
    df = m.open_items(
        model, "fact_invoice", "invoice_id", "doc_number", "customer_id", "txn_date", "due_date",
        "total_amount",
    ).withColumn("days_outstanding", days_late(F.col("due_date"), as_of))
    return named(df, model, "dim_customer", "customer_id", "display_name")


def open_bills(model, as_of) -> DataFrame:
    df = m.open_items(
        model, "fact_bill", "bill_id", "vendor_id", "txn_date", "due_date", "total_amount"
    ).withColumn("days_outstanding", days_late(F.col("due_date"), as_of))
    return named(df, model, "dim_vendor", "vendor_id", "display_name")


def month_ends(df: DataFrame, as_of) -> DataFrame:
    """Repeats each row for the twelve months up to `as_of`; the last one ends at `as_of`."""
    first = F.trunc(day(as_of), "MM")
    months = F.sequence(F.add_months(first, -11), first, F.expr("interval 1 month"))
    return df.withColumn("month", F.explode(months)).withColumn(
        "month_end", F.least(F.last_day("month"), day(as_of))
    )


def receivable_history(model) -> DataFrame:
    """Balances of every invoice and the days on which they hold: (client_id, invoice_id, due_date,
    balance, valid_from, valid_to). An invoice opens with its total on its date; each payment line
    linked to it lowers it on the payment's date."""
    key = ["client_id", "invoice_id"]
    opened = model.table("fact_invoice", *key, "txn_date", "due_date", "total_amount").withColumnRenamed("total_amount", "change")
    paid = (
        model.table("fact_payment_line", "client_id", "payment_id", "linked_invoice_id", "linked_txn_type", "amount")
        .where("linked_txn_type = 'Invoice' AND linked_invoice_id IS NOT NULL")
        .groupBy("client_id", "payment_id", F.col("linked_invoice_id").alias("invoice_id"))
        .agg((-F.sum("amount")).alias("change"))
        .join(model.table("fact_payment", "client_id", "payment_id", "txn_date"), ["client_id", "payment_id"], "left")
    )
    events = opened.select(*key, "txn_date", "change").unionByName(paid.select(*key, "txn_date", "change"))
    states = history.running_states(events, key, "txn_date", "change").withColumnRenamed("change", "balance")
    held = history.intervals(states, key, "txn_date")
    return held.join(opened.select(*key, "due_date"), key)


def receivables_on(model, days: DataFrame) -> DataFrame:
    """Open invoices as of each of `days`, by age on that day. Intervals with the same tenant, days and
    due date are added up first."""
    shape = ["client_id", "valid_from", "valid_to", "due_date"]
    held = receivable_history(model).where("balance > 0").groupBy(*shape).agg(
        F.sum("balance").alias("balance"), F.count(F.lit(1)).alias("invoices"))
    sums = aging.bucket_sums(F.col("day"), aging.RECEIVABLE_EDGES)
    return history.on_days(held, days).groupBy("client_id", "day").agg(
        *(c.alias(n) for n, c in sums.items()), F.sum("balance").alias("total_open"), F.sum("invoices").alias("open_invoices"))


def cash_on(model, days: DataFrame) -> DataFrame:
    """Bank position at the end of each of `days`: the current one less all later movements."""
    flow = F.when(of("payment"), F.col("amount")).otherwise(-F.col("amount"))
    # a movement is missing from the balance of every day before its own
    missing = movements(model, "payment", "purchase").where("txn_date IS NOT NULL").groupBy(
        *TENANT, F.lit(history.BEGINNING).alias("valid_from"), F.col("txn_date").alias("valid_to")).agg(F.sum(flow).alias("later"))
    later = history.on_days(missing, days).groupBy(*TENANT, "day").agg(F.sum("later").alias("later"))
    position = m.cash_position(model)
    asked = days.distinct().withColumn("_", F.lit(0)).join(position.withColumn("_", F.lit(0)), "_").drop("_")
    return asked.join(later, [*TENANT, "day"], "left").select(
        *TENANT, "day", (F.col("cash_position") - F.coalesce("later", F.lit(0))).alias("cash"))


def balance_as_of(model, days: DataFrame) -> DataFrame:
    """Receivables by age, open invoices, cash and their sum as of each of `days`."""
    df = receivables_on(model, days).join(cash_on(model, days), [*TENANT, "day"], "full")
    return df.withColumn("current_assets", blank_add(df.total_open, df.cash))


def month_ends_of(model, as_of) -> DataFrame:
    return history.month_end_days(model.table("fact_invoice", "txn_date"), "txn_date", as_of)


def dso_history(model, as_of) -> DataFrame:
    """Days sales outstanding at the end of every month since the first invoice, from the receivables
    that were open on that day and the revenue of its year up to it."""
    days = month_ends_of(model, as_of)
    monthly = (
        movements(model, "revenue", when=lambda d: d <= day(as_of))
        .groupBy(*TENANT, month(F.col("txn_date")).alias("earned")).agg(F.sum("amount").alias("amount"))
    )
    december = F.add_months(F.trunc("earned", "YEAR"), 11)
    to_date = (
        monthly.withColumn("_month", F.explode(F.sequence("earned", december, F.expr("interval 1 month"))))
        .groupBy(*TENANT, "_month").agg(F.sum("amount").alias("revenue_ytd"))
        .join(days.withColumn("_month", month(F.col("day"))), "_month")
        .select(*TENANT, "day", "revenue_ytd")
    )
    df = receivables_on(model, days).select(*TENANT, "day", "total_open").join(to_date, [*TENANT, "day"], "full")
    elapsed = F.datediff("day", F.trunc("day", "YEAR"))
    return df.withColumn("dso", m.days_outstanding(df.total_open, df.revenue_ytd, elapsed))


def dso_trend(model, as_of) -> DataFrame:
    """Days sales outstanding at twelve month ends. Open balances are current, so only the
    year-to-date revenue varies."""
    monthly = (
        movements(model, "revenue").where(F.col("txn_date") <= day(as_of))
        .groupBy(*TENANT, month(F.col("txn_date")).alias("earned"))
        .agg(F.sum("amount").alias("amount"))
    )
    december = F.add_months(F.trunc("earned", "YEAR"), 11)
    to_date = (
        monthly.withColumn(
            "month", F.explode(F.sequence("earned", december, F.expr("interval 1 month"))))
        .groupBy(*TENANT, "month").agg(F.sum("amount").alias("revenue_ytd"))
    )
    df = month_ends(m.open_totals(model, "fact_invoice"), as_of).join(
        to_date, [*TENANT, "month"], "left"
    )
    days = F.datediff("month_end", F.trunc("month_end", "YEAR"))
    return df.select(
        "client_id", "month_end", "revenue_ytd",
        m.days_outstanding(df.total_open, df.revenue_ytd, days).alias("dso"),
    )


def dpo_trend(model, as_of) -> DataFrame:
    """Days payable outstanding at twelve month ends, with the total billed up to each end."""
    bills = model.table("fact_bill", "client_id", "txn_date", "total_amount").where(
        F.col("txn_date") <= day(as_of))
    grid_start = F.add_months(F.trunc(day(as_of), "MM"), -11)
    billed = bills.groupBy(
        *TENANT, F.greatest(month(F.col("txn_date")), grid_start).alias("month")
    ).agg(F.sum("total_amount").alias("amount"))
    df = month_ends(m.open_totals(model, "fact_bill"), as_of).join(
        billed, [*TENANT, "month"], "left"
    )
    running = Window.partitionBy(*TENANT).orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    df = df.withColumn("billed", F.sum("amount").over(running))
    days = F.datediff("month_end", F.trunc("month_end", "YEAR"))
    return df.select(
        "client_id", "month_end", "billed",
        m.days_outstanding(df.total_open, df.billed, days).alias("dpo"),
    )


def payables_by_category(model) -> DataFrame:
    """Open bill balances per expense account type, split over a bill's lines by amount.

    Balances are split in whole cents by largest remainder, so a bill's parts add up to its balance and
    the categories to the open total. A bill without lines, or whose lines add up to nothing, is
    "Unassigned", as are lines without a known account.
    """
    key = ["client_id", "bill_id"]
    lines = model.table("fact_bill_line", *key, "account_id", "amount").groupBy(*key, "account_id").agg(
        cents(F.coalesce(F.sum("amount"), F.lit(0))).alias("part"))
    bills = m.open_items(model, "fact_bill", "bill_id").select(*key, cents(F.col("balance")).alias("balance"))
    split = apportioned(bills.join(lines, key, "left"), key, "balance", "part", "account_id")
    sums = split.groupBy("client_id", "account_id").agg(F.sum("share").alias("cents"))
    return named(sums, model, "dim_account", "account_id", "account_type").groupBy(
        *TENANT, F.coalesce("account_type", F.lit(UNASSIGNED)).alias("account_type")
    ).agg((F.sum("cents") / 100).cast("decimal(18,2)").alias("open_amount"))


# -- revenue ----------------------------------------------------------------------------------------

def revenue_cumulative(model) -> DataFrame:
    """Monthly revenue with the running total over calendar months."""
    running = Window.partitionBy(*TENANT).orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return m.monthly_revenue(model).withColumn("cumulative", F.sum("revenue").over(running))


def top_categories(model, n: int = 5) -> DataFrame:
    """Monthly revenue of each tenant's n largest item categories.

    Lines are summed per invoice and item first; the monthly series is then a few rows per
    category and is used twice.
    """
    lines = dated_lines(model, "fact_invoice_line", "fact_invoice", "invoice_id", "item_id")
    monthly_items = lines.groupBy(
        *TENANT, "item_id", month(F.col("txn_date")).alias("month")
    ).agg(F.sum("amount").alias("amount"))
    monthly = named(monthly_items, model, "dim_item", "item_id", "item_type").groupBy(
        *TENANT, "item_type", "month"
    ).agg(F.sum("amount").alias("revenue"))
    sums = monthly.groupBy(*TENANT, "item_type").agg(F.sum("revenue").alias("total"))
    best = top_n(sums, TENANT, [F.desc("total"), F.asc("item_type")], n)
    return monthly.join(best, [*TENANT, "item_type"], "left_semi")


def customer_ranking(model) -> DataFrame:
    """All customers by revenue with rank, invoice count and average invoice."""
    df = rank_within(customer_revenue(model), TENANT, "revenue")
    df = df.withColumn("average_invoice", mean(df.revenue, df.invoice_count))
    return named(df, model, "dim_customer", "customer_id", "display_name")


def customer_trend(model, as_of) -> DataFrame:
    """Monthly revenue per customer over the trailing year."""
    lines = (
        model.table("fact_invoice_line", "client_id", "invoice_id", "amount")
        .groupBy("client_id", "invoice_id").agg(F.sum("amount").alias("amount"))
    )
    invoices = model.table(
        "fact_invoice", "client_id", "invoice_id", "customer_id", "txn_date"
    ).where(trailing_year(F.col("txn_date"), as_of))
    return lines.join(invoices, ["client_id", "invoice_id"]).groupBy(
        *TENANT, "customer_id", month(F.col("txn_date")).alias("month")
    ).agg(F.sum("amount").alias("revenue"))


# -- expenses ---------------------------------------------------------------------------------------

def expense_by_type(model) -> DataFrame:
    spent = account_activity(model, "bill", "purchase").groupBy("client_id", "account_id").agg(
        F.sum("amount").alias("amount"))
    return named(spent, model, "dim_account", "account_id", "account_type").groupBy(
        *TENANT, "account_type"
    ).agg(F.sum("amount").alias("expenses"))


def largest_expense(model) -> DataFrame:
    """The account type with the largest expenses per tenant; ties go to the first name."""
    best = top_n(
        expense_by_type(model), TENANT, [F.desc("expenses"), F.asc("account_type")], 1
    )
    return best.drop("rank")


def expense_against_prior_year(model) -> DataFrame:
    monthly = (
        movements(model, "bill", "purchase")
        .groupBy(*TENANT, month(F.col("txn_date")).alias("month"))
        .agg(F.sum("amount").alias("expenses"))
    )
    df = with_prior(monthly, TENANT, "expenses", 12)
    return df.withColumn("change", blank.change(df.expenses, df.prior))


def expense_mix(model, n: int = 5) -> DataFrame:
    """Monthly expenses of the n largest accounts per tenant, the rest as Other."""
    monthly = account_months(model, "bill", "purchase")
    sums = monthly.groupBy(*TENANT, "account_id").agg(F.sum("amount").alias("total"))
    best = top_n(sums, TENANT, [F.desc("total"), F.asc("account_id")], n).select(
        *TENANT, "account_id", F.col("account_id").alias("category"))
    return (
        monthly.join(best, [*TENANT, "account_id"], "left")
        .groupBy(*TENANT, "month", F.coalesce("category", F.lit("Other")).alias("category"))
        .agg(F.sum("amount").alias("expenses"))
    )


def vendor_spend(model) -> DataFrame:
    """(client_id, vendor_id, month, spend): bills plus purchases."""
    wanted = ("client_id", "vendor_id", "txn_date", "total_amount")
    return (
        model.table("fact_bill", *wanted)
        .unionByName(paid_purchases(model, *wanted).drop("is_credit"))
        .groupBy("client_id", "vendor_id", month(F.col("txn_date")).alias("month"))
        .agg(F.sum("total_amount").alias("spend"))
    )


def top_vendors(model, as_of, n: int = 10) -> DataFrame:
    """Largest vendors by spend, with the current month against the month before it."""
    this = F.trunc(day(as_of), "MM")
    spend = vendor_spend(model).groupBy(*TENANT, "vendor_id").agg(
        F.sum("spend").alias("total_spend"),
        sum_if(F.col("month") == this, F.col("spend")).alias("current_month"),
        sum_if(F.col("month") == F.add_months(this, -1), F.col("spend")).alias("prior_month"),
    )
    best = top_n(spend, TENANT, [F.desc("total_spend"), F.asc("vendor_id")], n)
    best = best.withColumn("change", blank.change(best.current_month, best.prior_month))
    return named(best, model, "dim_vendor", "vendor_id", "display_name")


def vendor_share(model, n: int = 5) -> DataFrame:
    """The n largest vendors and their share of the tenant's spend."""
    spend = vendor_spend(model).groupBy(*TENANT, "vendor_id").agg(F.sum("spend").alias("spend"))
    whole = spend.groupBy(*TENANT).agg(F.sum("spend").alias("total_spend"))
    best = top_n(spend, TENANT, [F.desc("spend"), F.asc("vendor_id")], n)
    df = best.join(whole, TENANT)
    return df.withColumn("share", divide(df.spend, df.total_spend, 0))


# -- controls -----------------------------------------------------------------------------------------

def reconcile(model) -> DataFrame:
    """Header totals against line sums per transaction type: documents, differing documents
    and both totals. A document without lines, or lines without a document, differ."""
    pairs = {
        "invoice": ("fact_invoice", "fact_invoice_line", "invoice_id"),
        "bill": ("fact_bill", "fact_bill_line", "bill_id"),
        "purchase": ("fact_purchase", "fact_purchase_line", "purchase_id"),
        "payment": ("fact_payment", "fact_payment_line", "payment_id"),
        "estimate": ("fact_estimate", "fact_estimate_line", "estimate_id"),
    }
    none = F.lit(None).cast("decimal(18,2)")
    stacked = []
    for kind, (header, line, key) in pairs.items():
        headers = model.table(header, "client_id", key, "total_amount").select(
            "client_id", F.lit(kind).alias("kind"), F.col(key).alias("id"),
            F.col("total_amount").alias("header_total"), none.alias("line_total"))
        lines = model.table(line, "client_id", key, "amount").select(
            "client_id", F.lit(kind).alias("kind"), F.col(key).alias("id"),
            none.alias("header_total"), F.col("amount").alias("line_total"))
        stacked += [headers, lines]
    documents = union(stacked).groupBy(*TENANT, "kind", "id").agg(
        F.sum("header_total").alias("header_total"), F.sum("line_total").alias("line_total"))
    differs = ~F.col("header_total").eqNullSafe(F.col("line_total"))
    return documents.groupBy(*TENANT, "kind").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count(F.when(differs, F.lit(1))).alias("differing"),
        F.sum("header_total").alias("header_total"), F.sum("line_total").alias("line_total"),
    )
