"""Validity intervals, sums as of a day and running balances against day-by-day brute force."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import history
from ledgerloom.plans import measures, reports
from ledgerloom.sources.star import AS_OF, StarTables
from test_properties import Memory

SMALL = "/root/testdata/sf0.001"
START = dt.date(2023, 11, 20)


def on(n):
    return START + dt.timedelta(days=n)


def random_events(seed):
    pick = random.Random(seed)
    return [(pick.choice("ab"), str(pick.randrange(12)), pick.choice([None, *map(on, range(120))]), Decimal(pick.randrange(-50, 100))) for _ in range(200)]


@pytest.mark.parametrize("seed", range(3))
def test_states_and_days_against_brute_force(spark, seed):
    events = random_events(seed)
    frame = spark.createDataFrame(events, "client_id string, id string, day date, v decimal(18,2)")
    keys = ["client_id", "id"]
    held = history.intervals(history.running_states(frame, keys, "day", "v"), keys, "day")
    asked = [on(n) for n in range(-40, 160)]
    found = history.on_days(held, spark.createDataFrame([(d,) for d in asked + asked[:5]], "day date")).collect()
    want = defaultdict(lambda: None)
    for client, key, day, v in events:
        for d in asked:
            if day is None or day <= d:
                want[client, key, d] = (want[client, key, d] or 0) + v
    got = {(r.client_id, r.id, r.day): r.v for r in found}
    assert len(got) == len(found)
    assert got == {k: v for k, v in want.items() if v is not None}


@pytest.mark.parametrize("grain", ["DAY", "WEEK"])
def test_running_sums_without_gaps(spark, grain):
    start = (lambda d: d) if grain == "DAY" else (lambda d: d - dt.timedelta(days=d.weekday()))
    step = 1 if grain == "DAY" else 7
    daily = defaultdict(Decimal)
    for client, _, day, v in random_events(9):
        daily[client, start(day) if day else None] += v
    frame = spark.createDataFrame([(*k, v) for k, v in daily.items()], "client_id string, day date, v decimal(18,2)")
    others = spark.createDataFrame([("a",), ("c",)], "client_id string")
    last = on(130)
    dense = history.every_period(frame, ["client_id"], "day", ["v"], grain, F.lit(last), others)
    got = {(r.client_id, r.day): (r.v, r.total) for r in history.running_sum(dense, ["client_id"], "day", "v", "total").collect()}
    assert got.pop(("c", start(last))) == (0, 0)
    for client in "ab":
        days = sorted(d for c, d in daily if c == client and d)
        want, total = {}, Decimal(0)
        if (client, None) in daily:
            total = daily[client, None]
            want[None] = (total, total)
        d = days[0]
        while d <= max(days[-1], start(last)):
            total += daily.get((client, d), 0)
            want[d] = (daily.get((client, d), 0), total)
            d += dt.timedelta(days=step)
        assert {d: v for (c, d), v in got.items() if c == client} == want


def test_receivables_as_of_every_day(spark):
    """Invoices with part payments, one on the invoice's day, one undated, one too high, one for no invoice."""
    invoices = [("a", "1", on(0), on(30), Decimal(100)), ("a", "2", on(10), None, Decimal(50)), ("b", "1", on(5), on(6), Decimal(7)),
                ("a", "3", on(20), on(25), None), ("a", "4", None, on(1), Decimal(11))]
    lines = [("a", "p1", "1", "Invoice", Decimal(30)), ("a", "p1", "2", "Invoice", Decimal(50)), ("a", "p2", "1", "Invoice", Decimal(90)),
             ("b", "p3", "1", "Invoice", Decimal(2)), ("a", "p4", "4", "Invoice", Decimal(1)), ("a", "p2", "gone", "Invoice", Decimal(5)),
             ("a", "p2", "2", "CreditMemo", Decimal(9)), ("b", "lost", "1", "Invoice", Decimal(1))]
    payments = [("a", "p1", on(12)), ("a", "p2", on(70)), ("b", "p3", on(5)), ("a", "p4", None)]
    model = Memory(
        fact_invoice=spark.createDataFrame(invoices, "client_id string, invoice_id string, txn_date date, due_date date, total_amount decimal(18,2)"),
        fact_payment_line=spark.createDataFrame(lines, "client_id string, payment_id string, linked_invoice_id string, linked_txn_type string, amount decimal(18,2)"),
        fact_payment=spark.createDataFrame(payments, "client_id string, payment_id string, txn_date date"))
    asked = [on(n) for n in range(-3, 120)]
    found = reports.receivables_on(model, spark.createDataFrame([(d,) for d in asked], "day date")).collect()
    dates = {(c, p): d for c, p, d in payments}
    want = {}
    for d in asked:
        for client in "ab":
            open_ = {}
            for c, i, day, due, total in invoices:
                if c == client and (day is None or day <= d):
                    paid = sum(a for c2, p, j, kind, a in lines if (c2, j, kind) == (c, i, "Invoice") and (dates.get((c2, p)) or on(-99)) <= d)
                    if (total or 0) - paid > 0:
                        open_[i] = ((total or 0) - paid, due)
            if open_:
                late = sum(b for b, due in open_.values() if due and d > due)
                want[client, d] = (sum(b for b, _ in open_.values()), len(open_), late or None, sum(b for b, due in open_.values() if due is None) or None)
    got = {(r.client_id, r.day): (r.total_open, r.open_invoices, sum(filter(None, (r.days_1_30, r.days_31_60, r.days_61_90, r.over_90))) or None, r.undated) for r in found}
    assert got == want


def test_balances_end_at_the_current_ones(spark):
    star = StarTables(spark, SMALL)
    position = {r.client_id: r.cash_position for r in measures.cash_position(star).collect()}
    for grain in ("DAY", "WEEK"):
        rows = reports.cash_trend(star, AS_OF, grain).collect()
        for client, cash in position.items():
            days = sorted((r for r in rows if r.client_id == client), key=lambda r: r.period)
            assert days[-1].balance == cash
            assert days[0].balance - days[0].net_flow == cash - sum(r.net_flow for r in days)
            step = 1 if grain == "DAY" else 7
            assert [(b.period - a.period).days for a, b in zip(days, days[1:])] == [step] * (len(days) - 1)
            assert all(b.balance == a.balance + b.net_flow for a, b in zip(days, days[1:]))


def test_a_tenants_history_is_cut_by_month(spark):
    """The join with the days is on the month, and states are added up before it."""
    days = spark.createDataFrame([(on(0),), (on(40),)], "day date")
    plan = reports.receivables_on(StarTables(spark, SMALL), days)._jdf.queryExecution().optimizedPlan().toString()
    join = plan[: plan.index("Generate explode")]
    assert "Join Inner" in join and "(_month#" in join
    assert "Aggregate [client_id" in plan[plan.index("Generate explode"):]
