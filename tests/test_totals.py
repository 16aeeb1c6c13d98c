"""Breakdowns add up to their totals on documents without lines, lines without documents and totals
that differ from their lines."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest

from ledgerloom.operators.apportion import apportioned
from ledgerloom.plans import measures, reports
from test_properties import Memory
from test_rollup import pick_model

DAY = dt.date(2024, 1, 1)


@pytest.mark.parametrize("seed", range(3))
def test_largest_remainder(spark, seed):
    pick = random.Random(seed)
    groups = {}
    for g in range(60):
        names = pick.sample([None, *"abcdefgh"], pick.randrange(1, 9))
        groups[g] = (pick.randrange(1, 10 ** pick.choice([2, 5, 12])), {n: pick.choice([0, 1, 1, pick.randrange(-300, 900), pick.randrange(10 ** 12)]) for n in names})
    groups[99] = (100, {"a": 5, "b": -5})
    rows = [(g, n, whole, part) for g, (whole, parts) in groups.items() for n, part in parts.items()] + [(100, None, 77, None)]
    df = spark.createDataFrame([(g, n, Decimal(w), None if p is None else Decimal(p)) for g, n, w, p in rows],
                               "g int, name string, whole decimal(38,0), part decimal(38,0)")
    got = defaultdict(lambda: defaultdict(int))
    for r in apportioned(df, ["g"], "whole", "part", "name").collect():
        got[r.g][r.name] += int(r.share)
    assert dict(got.pop(100)) == {None: 77}
    assert dict(got.pop(99)) == {None: 100}
    groups.pop(99)
    for g, (whole, parts) in groups.items():
        total = sum(parts.values())
        if not total:
            assert {n: v for n, v in got[g].items() if v} == {None: whole}
            continue
        exact = {n: Fraction(whole * p, total) for n, p in parts.items()}
        low = {n: e.numerator // e.denominator for n, e in exact.items()}
        order = sorted(parts, key=lambda n: (-(exact[n] - low[n]), n is not None, n or ""))
        want = {n: low[n] + (i < whole - sum(low.values())) for i, n in enumerate(order)}
        assert dict(got[g]) == want and sum(want.values()) == whole


@pytest.mark.parametrize("seed", range(2))
def test_cash_out_by_category_adds_up(spark, seed):
    model = pick_model(spark, seed)
    out = defaultdict(Decimal)
    for r in reports.cash_by_party(model).where("direction = 'out'").collect():
        assert r.party is not None
        out[r.client_id] += r.amount or 0
    assert dict(out) == {r.client_id: r.cash_outflow for r in measures.cash_flow(model).collect() if r.cash_outflow is not None}
    inflow = defaultdict(Decimal)
    for r in reports.cash_by_party(model).where("direction = 'in'").collect():
        inflow[r.client_id] += r.amount or 0
    assert dict(inflow) == {r.client_id: r.cash_inflow for r in measures.cash_flow(model).collect()}


def test_open_payables_by_category_add_up(spark):
    pick = random.Random(4)
    bills = [(pick.choice("ab"), str(i), Decimal(pick.randrange(-200, 90000)) / 100, Decimal(pick.choice([0, 100]))) for i in range(80)]
    lines = [(*pick.choice(bills)[:2], pick.choice(["A", "B", "C", "?", None]), pick.choice([None, Decimal(0), Decimal(pick.randrange(-900, 4000)) / 100]))
             for _ in range(160)]
    model = Memory(
        fact_bill=spark.createDataFrame(bills, "client_id string, bill_id string, balance decimal(18,2), total_amount decimal(18,2)"),
        fact_bill_line=spark.createDataFrame(lines, "client_id string, bill_id string, account_id string, amount decimal(18,2)"),
        dim_account=spark.createDataFrame([(c, a, "type " + a) for c in "ab" for a in "ABC"], "client_id string, account_id string, account_type string"))
    total = defaultdict(Decimal)
    kinds = set()
    for r in reports.payables_by_category(model).collect():
        total[r.client_id] += r.open_amount
        kinds.add(r.account_type)
    assert kinds == {"type A", "type B", "type C", reports.UNASSIGNED}
    assert dict(total) == {r.client_id: r.total_open for r in measures.open_totals(model, "fact_bill").collect()}


def test_purchase_lines_without_a_header_are_kept(spark):
    lines = [("a", "1", "X", Decimal(3)), ("a", "gone", "X", Decimal(4)), ("a", "credit", "X", Decimal(5))]
    heads = [("a", "1", DAY, None), ("a", "credit", DAY, True)]
    model = Memory(
        fact_purchase=spark.createDataFrame(heads, "client_id string, purchase_id string, txn_date date, is_credit boolean"),
        fact_purchase_line=spark.createDataFrame(lines, "client_id string, purchase_id string, account_id string, amount decimal(18,2)"))
    assert sorted((r.amount, r.txn_date) for r in reports.account_activity(model, "purchase").collect()) == [(3, DAY), (4, None)]
