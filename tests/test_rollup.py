"""Measures from stored aggregates equal those from the facts, also where keys are missing."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from ledgerloom.plans import measures, reports, rollup
from test_properties import Memory

DAY = dt.date(2001, 5, 1)


def pick_model(spark, seed):
    """Facts with lines without header, account, item or amount, headers without lines, day or customer."""
    pick = random.Random(seed)
    tenants, days = "ab", [None, *(DAY + dt.timedelta(days=n * 17) for n in range(12))]

    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    def amount():
        return pick.choice([None, *(Decimal(pick.randrange(-500, 5000)) / 100 for _ in range(9))])

    def some(*values):
        return pick.choice([None, *values])

    def lines(n, key):
        return frame([(pick.choice(tenants), str(pick.randrange(30)), some("A", "B", "C", "?"), some("i", "j"), amount()) for _ in range(n)],
                     f"client_id string, {key} string, account_id string, item_id string, amount decimal(18,2)")

    def headers(n, key, party, *more):
        rows = [(t, str(i), pick.choice(days), some("c1", "c2", "c3"), amount(), amount(), pick.choice([True, False, None])) for t in tenants for i in range(n)]
        return frame(rows, f"client_id string, {key} string, txn_date date, {party} string, total_amount decimal(18,2), total_tax decimal(18,2), is_credit boolean")

    return Memory(
        fact_invoice=headers(20, "invoice_id", "customer_id"), fact_invoice_line=lines(120, "invoice_id"),
        fact_bill=headers(15, "bill_id", "vendor_id"), fact_bill_line=lines(60, "bill_id"),
        fact_purchase=headers(15, "purchase_id", "vendor_id"), fact_purchase_line=lines(60, "purchase_id"),
        fact_payment=headers(10, "payment_id", "customer_id"),
        dim_account=frame([(t, a, c, k, a) for t in tenants for a, c, k in (("A", "Revenue", "Income"), ("B", "Expense", "Cost of Goods Sold"), ("C", "Expense", "Expense"))],
                          "client_id string, account_id string, classification string, account_type string, fully_qualified_name string"),
        dim_item=frame([("a", "i", "goods"), ("b", "i", "work")], "client_id string, item_id string, item_type string"),
        dim_customer=frame([("a", "c1", "One")], "client_id string, customer_id string, display_name string"))


@pytest.mark.parametrize("seed", range(2))
def test_same_results_as_from_the_facts(spark, seed):
    model = pick_model(spark, seed)
    held = rollup.build(model)
    as_of = DAY + dt.timedelta(days=150)
    for build in (
        measures.revenue, lambda m: measures.revenue_to_date(m, as_of), lambda m: measures.revenue_against(m, 1), measures.invoice_measures,
        measures.revenue_per_customer, measures.expenses, lambda m: measures.expenses_to_date(m, as_of, "YEAR"), measures.profit,
        lambda m: measures.net_income_to_date(m, as_of), measures.cost_of_goods, measures.gross_profit, measures.collection_rate, measures.cash_flow,
        reports.revenue_by_item_type, reports.customer_revenue, reports.top_customers, reports.pnl_matrix, reports.pnl_waterfall, reports.pnl_by_grain,
        reports.expense_by_type, reports.expense_mix, lambda m: reports.revenue_and_expenses(m, as_of)):
        want, got = build(model), build(held)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_distinct_customers_of_any_period(spark):
    """A customer seen on many days counts once, over more customers than one bitmap holds; blank is one more."""
    rows = [("a", DAY + dt.timedelta(days=n % 40), str(n % 70000)) for n in range(90000)] + [("a", DAY, None), ("a", DAY, None), ("b", None, "1"), ("c", DAY, None)]
    invoices = spark.createDataFrame(rows, "client_id string, txn_date date, customer_id string")
    held = rollup.Rollup(None, None, None, rollup.customer_days(Memory(fact_invoice=invoices)))
    assert {r.client_id: r.customers for r in held.distinct_customers().collect()} == {"a": 70001, "b": 1, "c": 1}
    months = {(r.client_id, r.period): r.customers for r in rollup.customers_by_grain(held).collect() if r.grain == "month"}
    want = {}
    for client, day, customer in rows:
        want.setdefault((client, day and day.replace(day=1)), set()).add(customer)
    assert months == {k: len(v) for k, v in want.items()}


def test_numbers_are_dealt_and_not_bitmaps(spark):
    """A bitmap is made once per tenant, day and bucket, after the shuffle."""
    invoices = spark.createDataFrame([("a", DAY, "1"), ("a", DAY, "1"), ("a", DAY, None), ("b", DAY, "2")], "client_id string, txn_date date, customer_id string")
    days = rollup.customer_days(Memory(fact_invoice=invoices))
    plan = days._jdf.queryExecution().executedPlan().toString().split("\n")
    made = [i for i, line in enumerate(plan) if "bitmap_construct_agg" in line]
    assert len(made) == 2 and not any("Exchange" in line for line in plan[made[0]:made[1]])
    assert sorted((r.client_id, r.bucket is None) for r in days.collect()) == [("a", False), ("a", True), ("b", False)]


def test_facts_are_not_read_again(spark):
    held = rollup.build(pick_model(spark, 5))
    with pytest.raises(ValueError, match="not held"):
        held.table("fact_invoice_line")
    plan = reports.pnl_matrix(held)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan or "Relation" in plan
    assert plan.count("Relation [") <= 1  # the activity table alone; dimensions come from memory


def test_headers_count_once_beside_their_lines(spark):
    """Headers that occur twice, blank keys, headers without lines and lines without a header."""
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    day, other = DAY, DAY + dt.timedelta(days=1)
    head = [("a", "1", day, "c", 10), ("a", "1", day, "c", 10), ("a", "1", other, "c", 4), ("a", "2", day, "c", None), (None, "1", day, "c", 7), ("a", None, day, "c", 3)]
    line = [("a", "1", "A", "i", 1), ("a", "1", "B", "i", 2), ("a", "1", None, None, 3), ("a", "9", "A", "i", 5), (None, "1", "A", "i", 6), ("a", None, "A", "i", 8), ("a", None, "A", "i", 8)]
    def headers(key, party, more="total_tax"):
        kind = "boolean" if more == "is_credit" else "decimal(18,2)"
        value = False if more == "is_credit" else Decimal(1)
        return frame([(c, k, d, p, t and Decimal(t), value) for c, k, d, p, t in head], f"client_id string, {key} string, txn_date date, {party} string, total_amount decimal(18,2), {more} {kind}")
    def lines(key):
        return frame([(c, k, a, i, Decimal(x)) for c, k, a, i, x in line], f"client_id string, {key} string, account_id string, item_id string, amount decimal(18,2)")
    held = rollup.build(Memory(
        fact_invoice=headers("invoice_id", "customer_id"), fact_invoice_line=lines("invoice_id"), fact_bill=headers("bill_id", "vendor_id"), fact_bill_line=lines("bill_id"),
        fact_purchase=headers("purchase_id", "vendor_id", "is_credit"), fact_purchase_line=lines("purchase_id"), fact_payment=headers("payment_id", "customer_id")))
    got = {(r.client_id, r.kind, r.txn_date, r.party_id): (r.total_amount, r.documents, r.priced, r.total_tax, r.with_lines) for r in held.documents.collect()}
    for kind, tax in (("revenue", 1), ("bill", None), ("purchase", None)):
        assert {k[:1] + k[2:]: v for k, v in got.items() if k[1] == kind} == {
            ("a", day, "c"): (23, 4, 3, tax and 4, 1), ("a", other, "c"): (4, 1, 1, tax, 1), (None, day, "c"): (7, 1, 1, tax, None),
            ("a", None, None): (None, None, None, None, 2), (None, None, None): (None, None, None, None, 1)}
    assert got["a", "payment", day, "c"] == (23, 4, 3, None, None)
    activity = {(r.client_id, r.txn_date, r.account_id): (r.amount, r.lines) for r in held.activity.where("kind = 'bill'").collect()}
    assert activity == {
        ("a", day, "A"): (2, 2), ("a", day, "B"): (4, 2), ("a", day, None): (6, 2), ("a", other, "A"): (1, 1), ("a", other, "B"): (2, 1), ("a", other, None): (3, 1),
        ("a", None, "A"): (21, 3), (None, None, "A"): (6, 1)}
