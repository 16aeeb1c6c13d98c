"""Daily loads from landed files."""

import datetime as dt
import json

from ledgerloom.plans import etl
from ledgerloom.session import scratch_path
from ledgerloom.sources import archive
from ledgerloom.sources.warehouse import Warehouse
from test_records import ORD

T = dt.datetime(2024, 1, 1, 11)


def land(root, client, source, stamp, content):
    folder = root / client / source
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{stamp}.json").write_text(content if isinstance(content, str) else json.dumps(content, indent=2))


def counts(frame):
    return {(r.client_id, r.source_name): (r.records, r.damaged, r.refused) for r in frame.collect()}


def test_loads_repeat_without_doubling_and_bad_documents_stop_nobody(spark, tmp_path):
    landed, archived, root = tmp_path / "landed", scratch_path(spark, "archive"), scratch_path(spark, "warehouse")
    registry = tmp_path / "clients.json"
    registry.write_text(json.dumps([{"client_id": "a", "client_name": "A"}, {"client_id": "b", "client_name": "B"}], indent=2))
    users = spark.createDataFrame([("u@x", "a")], "user_email string, client_id string")
    item = {"Id": "9", "Name": "thing", "IncomeAccountRef": {"value": "INC"}}
    line = {"Id": "1", "Amount": 5, "DetailType": "SalesItemLineDetail", "SalesItemLineDetail": {"ItemRef": {"value": "9"}}}
    land(landed, "a", "Item", "20240101_110000", [item])
    land(landed, "a", "Invoice", "20240101_110000", [{"Id": "1", "TotalAmt": 5, "Line": [line]}, {}, {"TotalAmt": 6}])
    land(landed, "b", "Invoice", "20240101_110000", '[{"Id": "1"}, {"Id":')
    land(landed, "b", "Mystery", "20240101_110000", [{"Id": "1"}])
    land(landed, "b", "report_Nonsense", "20240101_110000", {"Header": {}})
    land(landed, "b", "report_CashFlow", "20240101_110000", "not json")

    def load():
        return counts(etl.daily_load(spark, str(landed), archived, root, str(registry), users))

    assert load() == {
        ("a", "Item"): (1, 0, 0), ("a", "Invoice"): (2, 0, 1), ("b", "Invoice"): (1, 1, 1),
        ("b", "Mystery"): (1, 0, 1), ("b", "report_Nonsense"): (1, 0, 1), ("b", "report_CashFlow"): (1, 1, 1)}
    warehouse = Warehouse(spark, root)
    reasons = {(r.client_id, r.source_name): r.reason for r in etl.quarantine(warehouse).collect()}
    assert reasons == {
        ("a", "Invoice"): "no id", ("b", "Invoice"): "damaged", ("b", "Mystery"): "unknown source",
        ("b", "report_Nonsense"): "unknown report", ("b", "report_CashFlow"): "damaged"}
    assert [(r.account_id, float(r.amount)) for r in warehouse.table("fact_invoice_line").collect()] == [("INC", 5.0)]
    assert warehouse.table("dim_date").count() > 4000 and warehouse.table("dim_client").count() == 2
    assert warehouse.table("security_user_client_map").count() == 1

    before = archive.read(spark, archived).count()
    assert load() == {} and archive.read(spark, archived).count() == before
    land(landed, "b", "Invoice", "20240102_110000", [{"Id": "2", "TotalAmt": 7}])
    assert load() == {("b", "Invoice"): (1, 0, 0)}
    assert archive.read(spark, archived).count() == before + 1
    assert sorted((r.client_id, r.invoice_id) for r in warehouse.table("fact_invoice").collect()) == [("a", "1"), ("b", "2")]


def test_a_failed_batch_is_repeated(spark, tmp_path, monkeypatch):
    landed, archived, root = tmp_path / "landed", scratch_path(spark, "archive"), scratch_path(spark, "warehouse")
    land(landed, "a", "Vendor", "20240101_110000", [{"Id": "1"}])
    with monkeypatch.context() as broken:
        broken.setattr(etl, "load_reports", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            etl.daily_load(spark, str(landed), archived, root)
        except RuntimeError:
            pass
    assert counts(etl.daily_load(spark, str(landed), archived, root)) == {("a", "Vendor"): (1, 0, 0)}
    assert archive.read(spark, archived).count() == 1
    assert Warehouse(spark, root).table("dim_vendor").count() == 1


def test_payment_lines_without_an_invoice_stay_apart(spark, tmp_path):
    landed, archived, root = tmp_path / "landed", scratch_path(spark, "archive"), scratch_path(spark, "warehouse")
    land(landed, "a", "Payment", "20240101_110000", [{"Id": "1", "TotalAmt": 30, "Line": [{"Amount": 10}, {"Amount": 20}]}])
    etl.daily_load(spark, str(landed), archived, root)
    lines = Warehouse(spark, root).table("fact_payment_line").collect()
    assert sorted((r.line_num, float(r.amount), r.linked_invoice_id) for r in lines) == [(1, 10.0, None), (2, 20.0, None)]


def test_records_are_parsed_once(spark, monkeypatch):
    """Headers, lines, quarantine and summary of a load read one written frame per entity."""
    from ledgerloom.operators import records

    parses = []
    parse = records.with_parsed
    monkeypatch.setattr(records, "with_parsed", lambda *a: parses.append(a[2]) or parse(*a))
    raw = spark.createDataFrame(
        [("a", "Invoice", (T, 0, n, 0), text) for n, text in enumerate(['{"Id":"1","TotalAmt":5,"Line":[{"Id":"1","Amount":5,"DetailType":"SalesItemLineDetail"}]}', '{"Id":', "{}"])]
        + [("a", "Bill", (T, 0, 0, 0), '{"Id":"7"}')], f"client_id string, source_name string, ord {ORD}, record string")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    summary = etl.load_all(raw, warehouse)
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert len(parses) == 2
    assert plan.count("from_json") <= 1  # sources that are no entity
    assert sorted((r.source_name, r.records, r.damaged, r.refused) for r in summary.collect()) == [("Bill", 1, 0, 0), ("Invoice", 3, 1, 2)]
    assert sorted(r.reason for r in etl.quarantine(warehouse).collect()) == [records.DAMAGED, records.KEYLESS]
    assert warehouse.table("fact_invoice_line").count() == 1
