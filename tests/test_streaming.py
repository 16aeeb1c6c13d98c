"""Incremental refresh: new files only, late files, repeated runs."""

from ledgerloom.session import scratch_path
from ledgerloom.sources.warehouse import Warehouse
from ledgerloom.streaming.refresh import refresh
from test_landing import land
from test_reports import data, document


def test_refresh(spark, tmp_path):
    landed, archived = str(tmp_path / "landed"), scratch_path(spark, "archive")
    root, progress = scratch_path(spark, "warehouse"), scratch_path(spark, "progress")
    warehouse = Warehouse(spark, root)

    def run():
        refresh(spark, landed, archived, root, progress).awaitTermination()
        rows = warehouse.table("fact_invoice", "client_id", "invoice_id", "total_amount").collect()
        return sorted((r.client_id, r.invoice_id, float(r.total_amount)) for r in rows)

    line = {"Id": "1", "Amount": 5, "DetailType": "SalesItemLineDetail"}
    land(landed, "a", "Invoice", "20240102_110000", [{"Id": "1", "TotalAmt": 10, "Line": [line]}, {"Id": "2", "TotalAmt": 20}])
    land(landed, "b", "Invoice", "20240102_110000", [{"Id": "1", "TotalAmt": 30}])
    land(landed, "b", "Term", "20240102_110000", [{"Id": "1", "Name": "N"}])
    land(landed, "b", "report_CashFlow", "20240102_110000", document([data("x")], name="CashFlow"))
    assert run() == [("a", "1", 10.0), ("a", "2", 20.0), ("b", "1", 30.0)]
    assert warehouse.table("fact_invoice_line").count() == 1
    assert warehouse.table("dim_term").count() == 1
    assert warehouse.table("report_rows").count() == 1

    land(landed, "a", "Invoice", "20240103_110000", [{"Id": "2", "TotalAmt": 21}, {"Id": "3", "TotalAmt": 31}])
    land(landed, "a", "Invoice", "20240101_110000", [{"Id": "1", "TotalAmt": 9}, {"Id": "4", "TotalAmt": 40}])
    expected = [("a", "1", 10.0), ("a", "2", 21.0), ("a", "3", 31.0), ("a", "4", 40.0), ("b", "1", 30.0)]
    assert run() == expected
    assert run() == expected
    assert spark.read.parquet(archived).count() == 9
