"""Hand-written source records: missing parts, unknown line types, repeated names, damage."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ledgerloom.operators import records
from ledgerloom.plans import etl
from ledgerloom.schemas import BOOKED, GENERIC_TABLES, TABLES, columns

ORD = "struct<ts:timestamp_ntz,block:bigint,pos:bigint,item:int>"
DAY = dt.datetime(2024, 1, 1)


def raw(spark, entity, *docs, client="t1"):
    rows = [
        (client, entity, (DAY, 0, i, 0), d if isinstance(d, str) else json.dumps(d))
        for i, d in enumerate(docs)
    ]
    return spark.createDataFrame(
        rows, f"client_id string, source_name string, ord {ORD}, record string")


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_tables():
    """32 declared tables, the report rows and the lines of four more documents."""
    assert len(TABLES) == 33 + len(BOOKED) and len(GENERIC_TABLES) == 14
    assert all(len(columns(t)) > 1 for t in TABLES)


def test_null_and_missing_references(spark):
    for doc in ({"Id": "1", "CustomerRef": None}, {"Id": "1"}):
        row = only(records.map_records(raw(spark, "Invoice", doc), "Invoice"))
        assert row.customer_id is None and row.total_tax == 0 and row.total_amount is None


def test_customer_defaults(spark):
    row = only(records.map_records(raw(spark, "Customer", {"Id": "1"}), "Customer"))
    assert (row.is_job, row.is_active, float(row.balance)) == (False, True, 0.0)
    full = {
        "Id": "1", "PrimaryEmailAddr": {"Address": "a@b"}, "PrimaryPhone": {"FreeFormNumber": "5"},
        "BillAddr": {"City": "X", "PostalCode": "9"}, "Job": True, "Active": False,
        "Balance": 12.345, "ParentRef": {"value": "7"}}
    row = only(records.map_records(raw(spark, "Customer", full), "Customer"))
    assert (row.email, row.phone, row.billing_city, row.billing_postal_code) == ("a@b", "5", "X", "9")
    assert (row.is_job, row.is_active, row.parent_customer_id) == (True, False, "7")
    assert str(row.balance) == "12.35"


def test_account_currency_parent_and_active(spark):
    docs = [
        {"Id": "1", "Name": "A", "FullyQualifiedName": "A"},
        {"Id": "2", "Name": "B", "Active": False, "SubAccount": True, "ParentRef": {"value": "1"},
         "CurrencyRef": {"value": "EUR"}, "CurrentBalance": -3}]
    a, b = records.map_records(raw(spark, "Account", *docs), "Account").orderBy("account_id").collect()
    assert (a.parent_account_id, a.is_active, a.currency_code, a.is_sub_account) == (None, True, "USD", False)
    assert (b.parent_account_id, b.is_active, b.currency_code, b.is_sub_account) == ("1", False, "EUR", True)


def test_generic_name_fallback(spark):
    docs = [{"Id": "1", "Name": "N"}, {"Id": "2", "Name": "N", "FullyQualifiedName": "P:N", "Active": False}]
    a, b = records.map_records(raw(spark, "Term", *docs), "Term").orderBy("id").collect()
    assert (a.fully_qualified_name, a.is_active) == ("N", True)
    assert (b.fully_qualified_name, b.is_active) == ("P:N", False)


def test_estimate_takes_first_linked_invoice(spark):
    doc = {"Id": "1", "LinkedTxn": [
        {"TxnId": "5", "TxnType": "PurchaseOrder"}, {"TxnId": "6", "TxnType": "Invoice"},
        {"TxnId": "7", "TxnType": "Invoice"}]}
    assert only(records.map_records(raw(spark, "Estimate", doc), "Estimate")).linked_invoice_id == "6"
    assert only(records.map_records(raw(spark, "Estimate", {"Id": "1"}), "Estimate")).linked_invoice_id is None


def test_empty_lines_keep_the_header(spark):
    for doc in ({"Id": "1", "Line": []}, {"Id": "1"}):
        df = raw(spark, "Invoice", doc)
        assert records.map_records(df, "Invoice").count() == 1
        assert records.flatten_lines(df, "Invoice").count() == 0


LINES = [
    {"Id": "1", "LineNum": 1, "Amount": 10, "DetailType": "SalesItemLineDetail",
     "SalesItemLineDetail": {"ItemRef": {"value": "i", "name": "I"}, "Qty": 2, "UnitPrice": 5,
                             "ItemAccountRef": {"value": "a", "name": "A"}, "ServiceDate": "2024-01-05"},
     "LinkedTxn": [{"TxnId": "9", "TxnType": "Estimate"}, {"TxnId": "8", "TxnType": "X"}]},
    {"Id": "2", "Amount": 4, "DetailType": "GroupLineDetail"},
    {"Id": "3", "Amount": 14, "DetailType": "SubTotalLineDetail"},
    {"Id": "4", "Amount": -1, "DetailType": "DiscountLineDetail"},
    {"Id": "5", "Amount": 1},
]


def test_sales_lines(spark):
    df = raw(spark, "Invoice", {"Id": "1", "Line": LINES})
    a, b, c = records.flatten_lines(df, "Invoice").orderBy("line_id").collect()
    assert (a.item_name, a.account_id, a.linked_txn_id, a.linked_txn_type) == ("I", "a", "9", "Estimate")
    assert (float(a.quantity), a.service_date) == (2.0, dt.date(2024, 1, 5))
    assert (b.line_id, b.detail_type, b.item_id) == ("2", "GroupLineDetail", None)
    assert (c.line_id, c.detail_type) == ("5", "")
    assert records.flatten_lines(raw(spark, "Estimate", {"Id": "1", "Line": LINES}), "Estimate").count() == 3


def test_expense_lines(spark):
    lines = [
        {"Id": "1", "Amount": 3, "DetailType": "ItemBasedExpenseLineDetail",
         "ItemBasedExpenseLineDetail": {"ItemRef": {"value": "i"}, "Qty": 3, "CustomerRef": {"value": "c", "name": "C"}},
         "AccountBasedExpenseLineDetail": {"AccountRef": {"value": "wrong"}}},
        {"Id": "2", "Amount": 4, "DetailType": "AccountBasedExpenseLineDetail",
         "AccountBasedExpenseLineDetail": {"AccountRef": {"value": "a", "name": "A"}, "BillableStatus": "Billable"}},
        {"Id": "3", "Amount": 7, "DetailType": "SubTotalLineDetail"},
        {"Id": "4", "Amount": 7, "DetailType": "Other"}]
    a, b = records.flatten_lines(raw(spark, "Bill", {"Id": "1", "Line": lines}), "Bill").orderBy("line_id").collect()
    assert (a.item_id, a.account_id, a.customer_name, float(a.quantity)) == ("i", None, "C", 3.0)
    assert (b.item_id, b.account_id, b.account_name, b.billable_status) == (None, "a", "A", "Billable")
    purchase = records.flatten_lines(raw(spark, "Purchase", {"Id": "1", "Line": lines}), "Purchase")
    assert purchase.count() == 2 and "quantity" not in purchase.columns


def test_payment_notes_last_name_wins(spark):
    def note(name, value):
        return {"value": {"Name": name, "Value": value}}
    lines = [
        {"Amount": 5, "LinkedTxn": [{"TxnId": "1", "TxnType": "Invoice"}],
         "LineEx": {"any": [note("txnOpenBalance", "1"), note("txnReferenceNumber", "R"), note("txnOpenBalance", "2")]}},
        {"Amount": 6}]
    a, b = records.flatten_lines(raw(spark, "Payment", {"Id": "p", "Line": lines}), "Payment").orderBy("amount").collect()
    assert (a.linked_invoice_id, a.original_open_balance, a.invoice_doc_number) == ("1", "2", "R")
    assert (b.linked_invoice_id, b.original_open_balance) == (None, None)


def test_damaged_records_are_set_aside(spark):
    df = raw(spark, "Invoice", {"Id": "1"}, '{"Id": "2", "Li', "not json", {"Id": "3"})
    assert [r.invoice_id for r in records.map_records(df, "Invoice").orderBy("invoice_id").collect()] == ["1", "3"]
    assert records.quarantine(df, "Invoice").count() == 2
    summary = etl.run_summary(df).collect()[0]
    assert (summary.records, summary.damaged) == (4, 2)


def test_last_version_wins_and_records_without_a_key_are_set_aside(spark):
    docs = [{"Id": "1", "TotalAmt": 1}, {"Id": None, "TotalAmt": 2}, {"Id": "1", "TotalAmt": 3}, {"TotalAmt": 4}, {"Id": " "}]
    df = raw(spark, "Invoice", *docs)
    rows = etl.clean_headers(df, "Invoice").collect()
    assert [(r.invoice_id, float(r.total_amount)) for r in rows] == [("1", 3.0)]
    assert [r.reason for r in records.quarantine(df, "Invoice").collect()] == ["no id"] * 3


def test_header_and_lines_are_refused_together(spark):
    df = raw(spark, "Invoice", {"Id": "1", "TotalAmt": 1, "Line": "no list"}, {"Id": "2", "TotalAmt": 2, "Line": LINES})
    assert [r.invoice_id for r in records.map_records(df, "Invoice").collect()] == ["2"]
    assert {r.invoice_id for r in records.flatten_lines(df, "Invoice").collect()} == {"2"}
    assert [r.reason for r in records.quarantine(df, "Invoice").collect()] == ["damaged"]


def test_unknown_sources_are_in_the_summary(spark):
    df = raw(spark, "Invoice", {"Id": "1"}).unionByName(raw(spark, "Mystery", {"Id": "1"}, "cut {"))
    assert {(r.source_name, r.records, r.damaged) for r in etl.run_summary(df).collect()} == {("Invoice", 1, 0), ("Mystery", 2, 1)}


def test_date_keys(spark):
    dated = etl.clean_headers(raw(spark, "Bill", {"Id": "1", "TxnDate": "2024-01-05", "DueDate": "soon"}), "Bill")
    row = only(dated)
    assert (row.txn_date_key, row.due_date_key) == (20240105, None)


def test_same_id_in_two_tenants_stays_apart(spark):
    both = raw(spark, "Vendor", {"Id": "1"}).unionByName(raw(spark, "Vendor", {"Id": "1"}, client="t2"))
    assert etl.clean_headers(both, "Vendor").count() == 2


def test_split_line_arrays_load_like_one(spark):
    whole = raw(spark, "Invoice", {"Id": "1", "TotalAmt": 9, "Line": LINES})
    parts = raw(spark, "Invoice", {"Id": "1", "TotalAmt": 9, "Line": LINES[:2]}, {"Id": "1", "TotalAmt": 9, "Line": LINES[2:]})
    for build in (etl.clean_headers, etl.clean_lines):
        a, b = (sorted(map(str, build(x, "Invoice").drop("ord").collect())) for x in (whole, parts))
        assert a == b
    assert parts.agg(F.count("*").alias("n")).first().n == 2
