"""Properties of measures and rankings on generated data."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aging
from ledgerloom.operators.access import visible_to
from ledgerloom.operators.periods import with_prior
from ledgerloom.operators.ranking import rank_within, top_n
from ledgerloom.plans import measures, reports
from ledgerloom.sources.star import AS_OF, StarTables

SMALL = "/root/testdata/sf0.001"


class Memory:
    """A model over given frames."""

    def __init__(self, **frames):
        self.frames = frames

    def table(self, name, *columns):
        return self.frames[name].select(*columns) if columns else self.frames[name]


def money(df, *names):
    return df.select(*(F.col(c).cast("decimal(18,2)").alias(c) if c in names else F.col(c) for c in df.columns))


@pytest.mark.parametrize("slices", [1, 4, 256])
def test_rank_within_equals_brute_force(spark, slices):
    rng = random.Random(slices)
    rows = [("hot", str(i), Decimal(rng.choice([0, 0, 5, rng.randrange(2000)]))) for i in range(3000)]
    rows += [("cold", "x", Decimal(1)), ("cold", "y", Decimal(1)), ("cold", "z", Decimal(-3))]
    df = spark.createDataFrame(rows, "client_id string, id string, v decimal(18,2)")
    got = {(r.client_id, r.id): r["rank"] for r in rank_within(df, ["client_id"], "v", slices=slices).collect()}
    assert len(got) == len(rows)
    for client in ("hot", "cold"):
        values = [v for c, _, v in rows if c == client]
        for c, i, v in rows:
            if c == client:
                assert got[c, i] == 1 + sum(x > v for x in values)


def test_top_n_breaks_ties_and_limits_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") < 900, "a").otherwise("b").alias("c"), "id", (F.col("id") % 2).alias("v"))
    best = top_n(df, ["c"], [F.desc("v"), F.asc("id")], 3)
    assert [(r.c, r.id) for r in best.orderBy("c", "rank").collect()] == [
        ("a", 1), ("a", 3), ("a", 5), ("b", 901), ("b", 903), ("b", 905)]
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_prior_period_respects_gaps(spark):
    rows = [("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 2, 1), 2.0), ("a", dt.date(2024, 5, 1), 5.0)]
    df = spark.createDataFrame(rows, "client_id string, month date, revenue double")
    got = {r.month.month: (r.revenue, r.prior) for r in with_prior(df, ["client_id"], "revenue", 1).collect()}
    assert got == {1: (1.0, None), 2: (2.0, 1.0), 3: (None, 2.0), 5: (5.0, None), 6: (None, 5.0)}


def test_aging_edges_and_undated(spark):
    as_of = dt.date(2024, 7, 1)
    late = [-1, 0, 1, 30, 31, 60, 61, 90, 91]
    rows = [("a", as_of - dt.timedelta(days=n), float(2 ** i)) for i, n in enumerate(late)]
    rows += [("a", None, 1000.0), ("a", as_of, -5.0), ("a", as_of, 0.0)]
    df = spark.createDataFrame(rows, "client_id string, due_date date, balance double")
    row = aging.aging(df, ["client_id"], as_of, aging.RECEIVABLE_EDGES).first()
    assert (row.not_due, row.days_1_30, row.days_31_60, row.days_61_90, row.over_90) == (3, 12, 48, 192, 256)
    assert row.undated == 1000 and row.total_open == 511 + 1000


def test_buckets_add_up_and_tenants_are_independent(spark):
    star = StarTables(spark, SMALL)
    for build in (measures.receivable_aging, measures.payable_aging):
        whole = build(star, AS_OF)
        parts = [c for c in whole.columns if c not in ("client_id", "total_open")]
        for row in whole.collect():
            assert sum(row[c] or 0 for c in parts) == row.total_open
    invoices = star.table("fact_invoice").cache()
    together = measures.receivable_aging(Memory(fact_invoice=invoices), AS_OF).collect()
    for row in together:
        alone = Memory(fact_invoice=invoices.where(F.col("client_id") == row.client_id))
        assert measures.receivable_aging(alone, AS_OF).collect() == [row]


def test_blank_rules_of_measures(spark):
    invoices = money(spark.createDataFrame(
        [("a", "1", "c1", dt.date(2024, 1, 1), 0.0, 5.0)],
        "client_id string, invoice_id string, customer_id string, txn_date date, balance double, total_amount double"),
        "balance", "total_amount")
    lines = money(spark.createDataFrame([("a", "1", 5.0)], "client_id string, invoice_id string, amount double"), "amount")
    none_lines = money(spark.createDataFrame([], "client_id string, bill_id string, amount double"), "amount")
    none_purchases = money(spark.createDataFrame(
        [], "client_id string, txn_date date, total_amount double, is_credit boolean"), "total_amount")
    payments = money(spark.createDataFrame([("b", dt.date(2024, 1, 1), 3.0)], "client_id string, txn_date date, total_amount double"), "total_amount")
    model = Memory(
        fact_invoice=invoices, fact_invoice_line=lines, fact_bill_line=none_lines,
        fact_purchase=none_purchases, fact_payment=payments)
    profit = measures.profit(model).collect()
    assert [(r.client_id, r.total_expenses, r.net_income, r.expense_ratio) for r in profit] == [("a", None, 5, None)]
    rates = {r.client_id: r.collection_rate for r in measures.collection_rate(model).collect()}
    assert rates == {"a": None, "b": 0.0}
    jan1 = measures.days_sales_outstanding(model, dt.date(2024, 1, 1)).collect()
    assert [(r.client_id, r.dso) for r in jan1] == [("a", None)]


def test_credits_are_excluded_and_unknown_flags_are_not(spark):
    df = money(spark.createDataFrame(
        [("a", 1.0, True), ("a", 2.0, False), ("a", 4.0, None)],
        "client_id string, total_amount double, is_credit boolean"), "total_amount")
    assert measures.totals(Memory(fact_purchase=df), "purchase").first().purchase == 6


def test_hierarchy_levels_missing_parents_and_cycles(spark):
    rows = [("a", str(i), str(i - 1) if i else None) for i in range(7)] + [("a", "x", "gone"), ("b", "1", "0")]
    df = spark.createDataFrame(rows, "client_id string, account_id string, parent_account_id string")
    got = {(r.client_id, r.account_id): (r.depth, r.root) for r in reports.hierarchy(df, "account_id", "parent_account_id").collect()}
    assert got["a", "6"] == (6, "0") and got["a", "x"] == (0, "x") and got["b", "1"] == (0, "1")
    deep = [("a", str(i), str(i - 1) if i else None) for i in range(70)]
    loop = [("a", "x", "y"), ("a", "y", "z"), ("a", "z", "y"), ("a", "w", "x"), ("b", "s", "s")]
    both = spark.createDataFrame(deep + loop, df.schema)
    rows = reports.hierarchy(both, "account_id", "parent_account_id").collect()
    assert {r.account_id for r in rows if r.cyclic} == {"x", "y", "z", "w", "s"}
    assert {r.account_id: r.depth for r in rows if not r.cyclic} == {str(i): i for i in range(70)}
    assert all(r.depth is None and r.root is None and r.path is None for r in rows if r.cyclic)


def test_row_level_security(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "client_id string, v int")
    users = spark.createDataFrame([("u", "a"), ("u", "a")], "user_email string, client_id string")
    assert [tuple(r) for r in visible_to(df, users, "u").collect()] == [("a", 1)]


def test_wide_pnl(spark):
    months = [dt.date(2001, 6, 1), dt.date(2001, 7, 1)]
    wide = reports.pnl_wide(StarTables(spark, SMALL), months)
    assert wide.columns == ["client_id", "classification", "fully_qualified_name", "2001-06-01", "2001-07-01"]
    assert wide.count() > 0


def test_blank_values_rank_last(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), ("a", 9), ("a", None)], "client_id string, v long")
    assert sorted((r.rank, r.v) for r in rank_within(df, ["client_id"], "v").collect() if r.v) == [(1, 9), (2, 5)]
    assert [r.rank for r in rank_within(df, ["client_id"], "v").where("v is null").collect()] == [3, 3]


def test_no_amount_is_lost_to_missing_keys(spark):
    """Lines without a header, an account or an amount: the total, the months and the matrix agree."""
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)
    model = Memory(
        fact_invoice=frame([("a", "1", "c", dt.date(2001, 5, 1), Decimal(10)), ("a", "2", "c", None, None)],
                           "client_id string, invoice_id string, customer_id string, txn_date date, total_amount decimal(18,2)"),
        fact_invoice_line=frame(
            [("a", "1", "INC", Decimal(10)), ("a", "1", None, Decimal(4)), ("a", "gone", "INC", Decimal(7)), ("a", "2", "?", Decimal(2)), ("a", "2", "INC", None)],
            "client_id string, invoice_id string, account_id string, amount decimal(18,2)"),
        fact_bill=frame([], "client_id string, bill_id string, txn_date date"),
        fact_bill_line=frame([], "client_id string, bill_id string, account_id string, amount decimal(18,2)"),
        fact_purchase=frame([], "client_id string, purchase_id string, txn_date date, total_amount decimal(18,2), is_credit boolean"),
        fact_purchase_line=frame([], "client_id string, purchase_id string, account_id string, amount decimal(18,2)"),
        dim_account=frame([("a", "INC", "Revenue", "Income")], "client_id string, account_id string, classification string, fully_qualified_name string"))
    assert measures.revenue(model).first().total_revenue == 23
    assert sum(r.revenue for r in measures.monthly_revenue(model).collect()) == 23
    assert sum(r.revenue for r in reports.customer_revenue(model).collect()) == 23
    by_month = [r for r in reports.pnl_by_grain(model).collect() if r.grain == "month"]
    assert sum(r.net_income for r in by_month) == 23
    totals = {r.classification: r.amount for r in reports.pnl_matrix(model).where("level = 'total'").collect()}
    assert totals["Revenue"] == 17 and totals[reports.UNASSIGNED] == 6


def test_average_invoice_skips_blank_amounts(spark):
    model = Memory(fact_invoice=money(spark.createDataFrame(
        [("a", "c", 9.0, 0.0), ("a", "c", 18.0, 0.0), ("a", "c", None, 0.0)],
        "client_id string, customer_id string, total_amount double, total_tax double"), "total_amount", "total_tax"))
    row = measures.invoice_measures(model).first()
    assert (row.average_invoice, row.invoice_count) == (Decimal("13.50"), 3)


def test_dated_measures_filter_headers_before_the_lines_are_joined(spark):
    """The date condition is in the scan of the headers, and nothing is summed per document."""
    star = StarTables(spark, SMALL)
    plan = measures.revenue_in_period(star, AS_OF, "MM")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join Inner"):]
    assert "o_orderdate" in below and "Aggregate" not in below
