import datetime as dt
import json

import pytest

from ledgerloom.operators import report_rows
from ledgerloom.plans import etl
from ledgerloom.sources import reports
from ledgerloom.sources.warehouse import Warehouse, materialize
from ledgerloom.session import scratch_path
from test_records import DAY, ORD


def cells(*values):
    return [{"value": v} for v in values]


def data(*values):
    return {"type": "Data", "ColData": cells(*values)}


def section(name, rows, summary=None, header=True):
    node = {"type": "Section", "Rows": {"Row": rows}}
    if header:
        node["Header"] = {"ColData": cells(name)}
    if summary:
        node["Summary"] = {"ColData": cells(*summary)}
    return node


def document(rows, titles=("Name", "Jan", "Jan"), name="ProfitAndLoss", start="2024-01-01"):
    return {
        "Header": {"ReportName": name, "StartPeriod": start, "EndPeriod": "2024-12-31"},
        "Columns": {"Column": [{"ColTitle": t} if t else {} for t in titles]},
        "Rows": {"Row": rows},
    }


def raw_reports(spark, *items, ts=DAY):
    rows = [("t1", source, (ts, 0, i, 0), json.dumps(doc)) for i, (source, doc) in enumerate(items)]
    return spark.createDataFrame(
        rows, f"client_id string, source_name string, ord {ORD}, record string")


ROWS = [
    section("Income", [
        section("Sales", [data("a", "1", "2", "extra"), {"ColData": cells("b", "3")}], ("Total Sales", "4", "2")),
        data("c", "5", "6"),
    ], ("Total Income", "9")),
    section("", [data("d")], header=False),
    section("Empty", [], ("Only", "0")),
    {"type": "Data"},
    {"type": "Other"},
    section("L1", [section("L2", [section("L3", [data("deep", "7")])])]),
]


def test_walk_order_sections_and_cells(spark):
    df = etl.report_rows(raw_reports(spark, ("report_ProfitAndLossCash", document(ROWS, ("Name", None, "Jan")))))
    rows = df.orderBy("row_ord").collect()
    got = [(r.section, r.row_type, [(c.title, c.value) for c in r.cells]) for r in rows]
    assert got == [
        ("Sales", "Data", [("Name", "a"), ("col_1", "1"), ("Jan", "2")]),
        ("Sales", "Data", [("Name", "b"), ("col_1", "3")]),
        ("Sales", "Summary", [("Name", "Total Sales"), ("col_1", "4"), ("Jan", "2")]),
        ("Income", "Data", [("Name", "c"), ("col_1", "5"), ("Jan", "6")]),
        ("Income", "Summary", [("Name", "Total Income"), ("col_1", "9")]),
        ("", "Data", [("Name", "d")]),
        ("Empty", "Summary", [("Name", "Only"), ("col_1", "0")]),
        ("", "Data", []),
        ("L3", "Data", [("Name", "deep"), ("col_1", "7")]),
    ]
    assert {(r.report_table, r.report_name) for r in rows} == {("report_profitandlosscash", "ProfitAndLoss")}


def test_pivot_takes_the_last_of_equal_titles(spark):
    df = etl.report_rows(raw_reports(spark, ("report_ProfitAndLoss", document([data("a", "1", "2"), data("b", "3")]))))
    rows = report_rows.pivot(df, ["Name", "Jan"]).orderBy("row_ord").collect()
    assert [(r.Name, r.Jan) for r in rows] == [("a", "2"), ("b", "3")]


def test_depth_has_no_bound(spark):
    row = data("x", "1", "1")
    for i in range(40):
        row = section(str(i), [row])
    rows = etl.report_rows(raw_reports(spark, ("report_ProfitAndLoss", document([row])), ("report_CashFlow", document([data("flat")])))).collect()
    names = [r.cells[0].value for r in rows if r.row_type == "Data"]
    assert sorted(names) == ["flat", "x"]


def test_texts_are_parsed_once(spark):
    """Deep or flat, a document's text is parsed in the scan and read as parts after it."""
    row = data("x", "1", "1")
    for i in range(5):
        row = section(str(i), [row])
    plans = []

    def watched(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, label)

    scanned = materialize(reports.scan(raw_reports(spark, ("report_ProfitAndLoss", document([row])))), "scanned")
    rows = report_rows.flatten_reports(scanned, watched)
    assert rows.count() == 1
    plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) == 8
    assert not any("from_json" in p or "parse_json" in p for p in plans)


def test_empty_and_unknown_reports(spark):
    raw = raw_reports(spark, ("report_ProfitAndLoss", {}), ("report_Nonsense", document(ROWS)))
    assert etl.report_rows(raw).count() == 0


def test_parameters():
    today = dt.date(2024, 5, 6)
    assert reports.parameters("BalanceSheet", today) == {"accounting_method": "Accrual", "date": "2024-05-06"}
    assert reports.parameters("AgedPayables", today) == {
        "aging_period": "30", "num_periods": "4", "start_date": "2024-01-01", "end_date": "2024-05-06"}
    with pytest.raises(ValueError, match="unknown report"):
        reports.parameters("Nope", today)
    assert len(reports.CATALOG) == 9


def test_later_pull_replaces_a_report_and_a_late_one_does_not(spark):
    warehouse = Warehouse(spark, scratch_path(spark, "w"))
    def load(names, ts):
        etl.load_reports(raw_reports(
            spark, ("report_CashFlow", document([data(n) for n in names], name="CashFlow")), ts=ts), warehouse)
        return sorted(r.cells[0].value for r in warehouse.table("report_rows").collect())
    assert load("abc", DAY) == ["a", "b", "c"]
    assert load("xy", DAY + dt.timedelta(days=1)) == ["x", "y"]
    assert load("abc", DAY) == ["x", "y"]


def test_backfill_years(spark):
    raw = raw_reports(
        spark, *((f"backfill_report_CashFlow_{y}", document([data(str(y))], start=f"{y}-01-01")) for y in (2021, 2022, 2023)),
        ("report_CashFlow", document([data("now")])))
    rows = etl.backfill(raw, 2022, 2023).collect()
    assert sorted((r.report_year, r.cells[0].value) for r in rows) == [(2022, "2022"), (2023, "2023")]


def test_wide_tables_have_the_titles_of_their_documents(spark):
    """Columns that differ by tenant and year, equal titles, titles like key columns, cells beyond them."""
    root = scratch_path(spark, "wide")

    def load(*items):
        report_rows.publish(etl.pulled_report_rows(raw_reports(spark, *items)), root)

    load(("report_ProfitAndLoss", document([data("a", "1", "2", "3", "beyond")], ("Name", "Jan", "Jan", "_Section"))),
         ("report_CashFlow", document([data("c", "9")], ("Name", "Total"), name="CashFlow")))
    later = document([data("b", "5", "6")], ("Name", "Feb", "jan"), start="2025-01-01")
    load(("report_ProfitAndLoss", later))
    load(("report_ProfitAndLoss", document([data("b", "7")], ("Name", "Mar"), start="2025-01-01")))  # the year anew
    wide = report_rows.wide_table(spark, root, "report_profitandloss")
    names = {c for c in wide.columns if c.lstrip("_") not in report_rows.WIDE_KEYS}
    assert names == {"Name", "Jan", "_Section (2)", "Mar"}
    rows = {r.Name: (r.Jan, r["_Section (2)"], r.Mar, r._section) for r in wide.collect()}
    assert rows == {"a": ("2", "3", None, ""), "b": (None, None, "7", "")}
    assert set(report_rows.wide_table(spark, root, "report_cashflow").columns) >= {"Name", "Total"}


def test_titles_that_differ_in_case_only():
    assert report_rows.column_names(["Total", "total", "", "TOTAL"]) == {"Total": "Total", "total": "total (2)", "": "_", "TOTAL": "TOTAL (3)"}
