"""What loads shuffle, sort and write: wide rows are moved once."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from ledgerloom import loads
from ledgerloom.operators import records
from ledgerloom.plans import etl, rollup
from ledgerloom.session import scratch_path
from ledgerloom.sources import archive, documents, files, star as star_tables
from ledgerloom.sources.star import StarTables, StoredStar
from ledgerloom.sources.warehouse import Warehouse, materialize

STAMP = dt.datetime(2024, 1, 1)


@pytest.fixture
def joined(spark):
    """Without broadcasts, as on tables of any size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_are_archived_by_the_tasks_that_hold_them(spark):
    raw = spark.range(0, 40, 1, 4).select(
        F.concat(F.lit("t"), F.col("id") % 2).alias("client_id"), F.lit("Invoice").alias("source_name"),
        F.struct(F.lit(STAMP).cast("timestamp_ntz").alias("ts"), F.lit(0).cast("bigint").alias("block"), "id", F.lit(0).alias("item")).alias("ord"),
        F.col("id").cast("string").alias("record"))
    path = scratch_path(spark, "archive")
    archive.append(raw.withColumn("ord", F.expr("named_struct('ts', ord.ts, 'block', ord.block, 'pos', ord.id, 'item', ord.item)")), path)
    assert len(glob.glob(f"{path}/*/*/*.zstd.parquet")) == 8
    got = sorted((r.client_id, int(r.record)) for r in archive.read(spark, path).collect())
    assert got == sorted((f"t{i % 2}", i) for i in range(40))


def test_only_lines_without_an_account_meet_the_items(joined):
    warehouse = Warehouse(joined, scratch_path(joined, "warehouse"))
    warehouse.upsert("dim_item", joined.createDataFrame(
        [("a", "i", "INC", "EXP"), ("a", "j", None, None)], "client_id string, item_id string, income_account_id string, expense_account_id string"))
    rows = [("a", "1", "i", None), ("a", "2", "i", "own"), ("a", "3", None, None), ("a", "4", "x", None), ("b", "5", "i", None), (None, "6", "i", None), ("a", "7", "j", None)]
    lines = materialize(joined.createDataFrame(rows, "client_id string, line_id string, item_id string, account_id string"), "lines")
    filled = etl.with_item_accounts(lines, "Bill", warehouse)
    assert {r.line_id: r.account_id for r in filled.collect()} == {"1": "EXP", "2": "own", "3": None, "4": None, "5": None, "6": None, "7": None}
    assert filled.columns == lines.columns
    assert "isnull(account_id" in plan(filled)


def test_line_arrays_meet_their_headers_without_another_shuffle(joined):
    lines = materialize(joined.range(30).select(
        F.lit("a").alias("client_id"), (F.col("id") % 7).cast("string").alias("invoice_id"), (F.col("id") * 100).alias("line_num"), F.col("id").alias("amount")), "lines")
    headers = materialize(lines.select("client_id", "invoice_id").distinct(), "headers")
    arrays = documents.line_arrays(lines, "invoice_id", F.struct(F.col("amount").alias("Amount")), subtotal=False)
    met = headers.join(arrays, ["client_id", "invoice_id"], "left")
    assert plan(met).count("Exchange hashpartitioning") == 2
    assert sorted(x.Amount for r in met.collect() for x in r.Line) == list(range(30))


def test_subtotals_are_built_without_json(spark):
    lines = spark.createDataFrame([("a", "1", 1, 2), ("a", "1", 2, 3), ("a", "2", 1, None), ("a", "3", 1, 7)], "client_id string, invoice_id string, line_num int, n int").withColumn(
        "amount", F.col("n").cast("decimal(18,2)"))
    line = F.struct(F.col("line_num").alias("Id"), F.col("amount").alias("Amount"), F.lit("x").alias("DetailType"), F.struct(F.col("n").alias("Qty")).alias("Detail"))
    arrays = documents.line_arrays(lines, "invoice_id", line, subtotal=True)
    got = {r.invoice_id: r.Line[-1].asDict() for r in arrays.collect()}
    assert got == {k: {"Id": None, "Amount": v, "DetailType": "SubTotalLineDetail", "Detail": None} for k, v in (("1", 5), ("2", None), ("3", 7))}
    assert "json" not in plan(arrays).lower()


def test_rows_go_to_the_files_of_their_folders_without_a_sort(spark):
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == files.OPEN_FILES >= warehouse.slices
    rows = spark.range(500).select(F.lit("a").alias("client_id"), F.col("id").cast("string").alias("invoice_id"), F.col("id").alias("total_amount"))
    warehouse.upsert("fact_invoice", rows.where("id < 0"))
    warehouse.upsert("fact_invoice", rows)  # into an empty table: nothing to merge
    warehouse.upsert("fact_invoice", rows.withColumn("total_amount", F.col("total_amount") + 1).where("id % 2 = 0"))
    held = warehouse.table("fact_invoice").collect()
    assert sorted((int(r.invoice_id), int(r.total_amount)) for r in held) == [(i, i + (i % 2 == 0)) for i in range(500)]


def test_tax_and_lines_share_the_dealt_lines(spark, tmp_path):
    """Both read order lines under the same filter, so Spark deals and sorts them once."""
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "A")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
        "customer": ("c_custkey bigint, c_nationkey int", [(1, 0)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(1, 1, "O", 10.0, STAMP, "x"), (2, 1, "F", 5.0, STAMP, "x")]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                     [(1, 1, 1, 1, 1.0, 10.0, 0.0, 0.1, "N", "O", STAMP), (None, 1, 1, 1, 1.0, 10.0, 0.0, 0.1, "N", "O", STAMP)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    invoices = StarTables(spark, str(tmp_path)).table("fact_invoice", "client_id", "invoice_id", "total_tax")
    assert sorted((r.invoice_id, float(r.total_tax)) for r in invoices.collect()) == [("1", 1.0), ("2", 0.0)]
    assert "isnotnull(l_orderkey" in invoices._jdf.queryExecution().optimizedPlan().toString()


def test_resold_documents_are_parsed_once(spark, monkeypatch):
    """Lines and headers are read from a written copy of parsed records."""
    written = []
    monkeypatch.setattr(loads, "materialize", lambda df, label: written.append(df.columns) or materialize(df, label))
    star = StarTables(spark, "/root/testdata/sf0.001")
    assert loads.resold("RefundReceipt")(star).count() > 0
    assert written and {"r", "reason"} <= set(written[0])


def odd_tables(spark, folder):
    """Orders, parts and lines that occur twice, lines without an order or a part, and blank keys."""
    line = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "A"), (1, "B")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0), (1, "M", 1)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "x", 0, 1.0, "s"), (2, "y", 1, 2.0, "s"), (2, "z", 1, 2.0, "s")]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 0, 1.0)]),
        "part": ("p_partkey bigint, p_name string, p_type string, p_retailprice double", [(1, "p", "ECONOMY", 1.0), (2, "q", "LARGE", 1.0), (2, "r", "PROMO", 1.0), (None, "n", "PROMO", 1.0)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string", [
            (1, 1, "O", 10.0, STAMP, "1-URGENT"), (2, 1, "F", 5.0, STAMP, "x"), (2, 1, "F", 5.0, STAMP, "x"), (3, 2, "P", 7.0, None, "x"), (4, None, "P", 7.0, STAMP, "x"), (None, 1, "F", 1.0, STAMP, "x")]),
        "lineitem": (line, [
            (order, number, part, supplier, 2.0, 10.0 + (number or 0), 0.1, 0.1, flag, status, STAMP)
            for order in (1, 2, 3, 4, 9, None) for number, part, supplier, flag, status in (
                (1, 1, 1, "A", "O"), (2, 2, 1, "R", "F"), (1, 2, 1, "R", "F"), (3, None, None, "N", "O"), (4, 8, 2, "A", "F"), (5, 2, 1, "A", None), (None, 1, 1, "R", "F"))]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_stored_order_lines_give_the_same_tables(spark, tmp_path):
    folder = odd_tables(spark, tmp_path)
    plain, stored, spare = StarTables(spark, folder), StoredStar(spark, folder), StoredStar(spark, folder, details=False)
    for name in ("invoice", "invoice_line", "bill", "bill_line", "purchase", "purchase_line", "payment", "estimate", "estimate_line"):
        want = rows_of(plain.table(f"fact_{name}"))
        assert want and rows_of(stored.table(f"fact_{name}")) == want, name
        if not name.startswith("estimate"):
            wanted = ("client_id", "account_id", "item_id", "amount") if name.endswith("_line") else ("client_id", "txn_date", "total_amount")
            assert rows_of(spare.table(f"fact_{name}", *wanted)) == rows_of(plain.table(f"fact_{name}", *wanted)), name
    with pytest.raises(ValueError, match="not stored"):
        spare.table("fact_invoice_line", "quantity")


def test_aggregates_read_the_order_lines_once(spark, tmp_path, monkeypatch):
    folder, plans = odd_tables(spark, tmp_path), []

    def write(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, label)
    monkeypatch.setattr(star_tables, "materialize", write, raising=False)
    monkeypatch.setattr(rollup, "materialize", write)
    from ledgerloom.catalog import QUERIES
    assert QUERIES["rollup_measures"](spark, folder).count() > 0
    assert sum("l_extendedprice" in line for p in plans for line in p.split("\n") if "Relation [" in line) == 1


def hash_exchanges(df):
    return [line.split("hashpartitioning(")[1] for line in plan(df).split("\n") if "Exchange hashpartitioning(" in line]


@pytest.mark.parametrize("build", [documents.invoices, documents.estimates, documents.bills, documents.purchases])
def test_lines_and_headers_of_built_documents_lie_by_order(joined, tmp_path, build):
    """Neither is dealt again by the document's id."""
    keys = hash_exchanges(build(StarTables(joined, odd_tables(joined, tmp_path))))
    assert keys and not [k for k in keys if k.startswith("client_id") or "_id#" in k]
    # the lines, with their part, come to their order once
    assert sum(k.startswith("l_partkey#") for k in keys) == 1


@pytest.mark.parametrize("entity", ["Invoice", "Estimate", "Bill", "Purchase"])
def test_built_documents_hold_all_lines_of_odd_tables(spark, tmp_path, entity):
    """Lines per document as joined by its id, with repeated orders and parts and blank suppliers."""
    star, table, key = StarTables(spark, odd_tables(spark, tmp_path)), entity.lower(), f"{entity.lower()}_id"
    built = documents.BUILDERS[entity](star).select("client_id", F.get_json_object("record", "$.Id").alias(key), "record")
    size = F.coalesce(F.json_array_length(F.get_json_object("record", "$.Line")), F.lit(1)) - 1  # without the subtotal
    got = built.groupBy("client_id", key).agg(F.sum(size))
    headers = star.table(f"fact_{table}", "client_id", key)
    lines = {
        "Invoice": lambda: star.table("fact_invoice_line", "client_id", key, "item_name"),
        "Estimate": lambda: star.table("fact_estimate_line", "client_id", key, "item_name"),
        "Bill": lambda: star.table("fact_bill_line", "client_id", key, "account_id"),
        "Purchase": lambda: star.table("fact_purchase_line", "client_id", key, "account_id"),
    }[entity]().groupBy("client_id", key).count()
    want = headers.join(lines, ["client_id", key], "left").groupBy("client_id", key).agg(F.coalesce(F.sum("count"), F.lit(0)))
    assert want.count() and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def resold_records(spark, *rows):
    """(client, id, day, total, lines) as credit memos, parsed and written."""
    raw = spark.createDataFrame([
        (c, "CreditMemo", (STAMP + dt.timedelta(days=d), 0, n, 0), '{%s"TxnDate":"2024-01-0%d","TotalAmt":"%s","CustomerRef":{"value":"c%d"},"Line":[%s]}' % (
            f'"Id":"{i}",' if i else "", d + 1, t, d, ",".join('{"Id":"%s","Amount":"1"}' % x for x in lines)))
        for n, (c, i, d, t, lines) in enumerate(rows)],
        "client_id string, source_name string, ord struct<ts:timestamp_ntz,block:bigint,pos:bigint,item:int>, record string")
    return materialize(records.parsed_once(raw, "CreditMemo"), "resold-test")


def test_lines_bring_their_own_header(joined):
    """Of a document in one record the lines are not moved; the others meet the last header."""
    raw = resold_records(joined, ("a", "1", 0, 5, "xy"), ("a", "2", 1, 7, ""), ("b", "1", 2, None, "z"), (None, "3", 0, 1, "x"), ("a", None, 0, 1, "x"))
    got = loads.headed_lines(raw, "CreditMemo")
    assert sorted((r.client_id, r.credit_memo_id, r.line_id, str(r.txn_date), r.total_amount and int(r.total_amount), r.party_id) for r in got.collect()) == [
        ("a", "1", "x", "2024-01-01", 5, "c0"), ("a", "1", "y", "2024-01-01", 5, "c0"), ("b", "1", "z", "2024-01-03", None, "c2")]
    assert not hash_exchanges(got)


def test_lines_of_several_records_meet_the_last_header(joined):
    raw = resold_records(joined, ("a", "1", 1, 6, "y"), ("a", "1", 0, 5, "x"), ("a", "1", 2, 7, ""), ("a", "2", 0, 8, "x"), ("b", "1", 0, 9, "x"))
    got = loads.headed_lines(raw, "CreditMemo")
    assert sorted((r.client_id, r.credit_memo_id, r.line_id, int(r.total_amount), r.party_id) for r in got.collect()) == [
        ("a", "1", "x", 7, "c2"), ("a", "1", "y", 7, "c2"), ("a", "2", "x", 8, "c0"), ("b", "1", "x", 9, "c0")]
