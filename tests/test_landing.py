import datetime as dt
import json
import os

import pytest

from ledgerloom.operators import records
from ledgerloom.sources import landing, registry


def land(root, client, source, stamp, data, indent=2):
    folder = os.path.join(root, client, source)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{stamp}.json"), "w") as file:
        file.write(data if isinstance(data, str) else json.dumps(data, indent=indent))


def invoice(i):
    return {
        "Id": str(i), "TotalAmt": i + 0.5, "Note": 'a } , { ] [ "quoted" \n new line',
        "Line": [{"Id": "1", "Amount": i, "DetailType": "SalesItemLineDetail",
                  "SalesItemLineDetail": {"ItemRef": {"value": "x"}}}, {"Id": "2", "Amount": 1}],
        "Tags": [{"k": [1, 2, {"z": []}]}, {}],
    }


@pytest.mark.parametrize("split", ["128m", "1k", "300b"])
@pytest.mark.parametrize("n", [1, 2, 57])
def test_indented_arrays_split_by_byte_range(spark, tmp_path, split, n):
    land(tmp_path, "t1", "Invoice", "20240101_110000", [invoice(i) for i in range(n)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = landing.scan(spark, str(tmp_path))
        if split != "128m" and n == 57:
            assert df.rdd.getNumPartitions() > 4
        rows = df.orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [json.loads(r.record) for r in rows] == [invoice(i) for i in range(n)]
    assert {(r.client_id, r.source_name, r.ord.ts) for r in rows} == {
        ("t1", "Invoice", dt.datetime(2024, 1, 1, 11))}


def test_other_document_forms(spark, tmp_path):
    land(tmp_path, "t 1", "Invoice", "20240101_110000", [invoice(i) for i in range(3)], indent=None)
    land(tmp_path, "t2", "Invoice", "20240101_110000", [])
    land(tmp_path, "t3", "CompanyInfo", "20240101_110000", {"Id": "1", "Name": "N", "A": {"b": [{"c": 1}, {"d": 2}]}})
    land(tmp_path, "t4", "CompanyInfo", "20240101_110000", {})
    land(tmp_path, "t5", "Invoice", "20240101_110000", '[{"Id": "1"}, {"Id":')
    land(tmp_path, "t6", "Invoice", "20240101_110000", [{"Id": "1"}], indent=4)
    got = {}
    for row in landing.scan(spark, str(tmp_path)).orderBy("ord").collect():
        got.setdefault(row.client_id, []).append(row.record)
    assert [json.loads(x)["Id"] for x in got["t 1"]] == ["0", "1", "2"]
    assert "t2" not in got and "t4" not in got
    assert json.loads(got["t3"][0])["A"]["b"][1] == {"d": 2}
    assert [json.loads(x)["Id"] for x in got["t6"]] == ["1"]
    raw = landing.scan(spark, str(tmp_path))
    assert records.quarantine(raw, "Invoice").where("client_id = 't5'").count() == 1
    assert records.map_records(raw, "Invoice").count() == 4


@pytest.mark.parametrize("layout", ["1", "1_2", "__1__2_3__", "_1", "1_", "__"])
def test_empty_records_between_others(spark, tmp_path, layout):
    """`_` is an empty record, a digit one with that id."""
    land(tmp_path, "t1", "Invoice", "20240101_110000", [{} if c == "_" else {"Id": c, "Line": [{"Id": "x", "Sub": {}}, {}]} for c in layout])
    raw = landing.scan(spark, str(tmp_path))
    ids = [r.record and json.loads(r.record)["Id"] for r in raw.orderBy("ord").collect()]
    assert ids == [c for c in layout if c != "_"]
    assert records.quarantine(raw, "Invoice").count() == 0


def test_text_after_a_record_is_damage(spark, tmp_path):
    land(tmp_path, "t1", "Invoice", "20240101_110000", '[\n  {\n    "Id": "1"\n  },\n  oops,\n  {\n    "Id": "2"\n  }\n]')
    raw = landing.scan(spark, str(tmp_path))
    assert records.quarantine(raw, "Invoice").count() == 1


def test_registry_keeps_first_entry(spark, tmp_path):
    path = tmp_path / "clients.json"
    path.write_text(json.dumps([
        {"client_id": "a", "client_name": "A", "qbo_realm_id": "1", "onboarded_date": "2024-01-05", "is_active": False},
        {"client_id": "a", "client_name": "again"}, {"client_id": "b", "client_name": "B"}], indent=2))
    a, b = registry.read(spark, str(path)).orderBy("client_id").collect()
    assert (a.client_name, a.is_active, a.onboarded_date) == ("A", False, dt.date(2024, 1, 5))
    assert (b.client_name, b.is_active, b.qbo_realm_id) == ("B", True, "pending")
