import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import merge as merging
from ledgerloom.operators.quality import keep_last, key_violations
from ledgerloom.schemas import columns
from ledgerloom.session import scratch_path
from ledgerloom.sources.warehouse import Warehouse, bucket_columns, materialize


def invoices(spark, *rows):
    return spark.createDataFrame(list(rows), "client_id string, invoice_id string, total_amount double, ts timestamp_ntz")


def content(warehouse):
    rows = warehouse.table("fact_invoice", "client_id", "invoice_id", "total_amount").collect()
    return sorted((r.client_id, r.invoice_id or "-", float(r.total_amount)) for r in rows)


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, scratch_path(spark, "warehouse"))


T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_upsert_inserts_updates_keeps_and_matches_null_keys(spark, warehouse):
    assert content(warehouse) == []
    warehouse.upsert("fact_invoice", invoices(spark, ("a", "1", 1.0, T1), ("a", "2", 2.0, T1), ("b", "1", 3.0, T1), ("a", None, 4.0, T1)))
    batch = invoices(spark, ("a", "2", 20.0, T1), ("a", "3", 30.0, T1), ("a", None, 40.0, T1))
    warehouse.upsert("fact_invoice", batch)
    expected = [("a", "-", 40.0), ("a", "1", 1.0), ("a", "2", 20.0), ("a", "3", 30.0), ("b", "1", 3.0)]
    assert content(warehouse) == expected
    warehouse.upsert("fact_invoice", batch)
    assert content(warehouse) == expected
    warehouse.upsert("fact_invoice", batch.limit(0))
    assert content(warehouse) == expected


def test_two_batches_equal_one(spark):
    first = invoices(spark, *(("a", str(i), float(i), T1) for i in range(20)))
    second = invoices(spark, *(("a", str(i), i * 10.0, T2) for i in range(10, 30)))
    one, two = (Warehouse(spark, scratch_path(spark, "w")) for _ in range(2))
    two.upsert("fact_invoice", first, [F.col("ts")])
    two.upsert("fact_invoice", second, [F.col("ts")])
    one.upsert("fact_invoice", first.unionByName(second), [F.col("ts")])
    assert content(one) == content(two)


def test_late_data_does_not_undo_newer_data(spark, warehouse):
    version = F.col("ts")
    warehouse.upsert("fact_invoice", invoices(spark, ("a", "1", 2.0, T2), ("a", "2", 2.0, T1)), version=version)
    warehouse.upsert("fact_invoice", invoices(spark, ("a", "1", 1.0, T1), ("a", "2", 3.0, T1), ("a", "3", 1.0, T1)), version=version)
    assert content(warehouse) == [("a", "1", 2.0), ("a", "2", 3.0), ("a", "3", 1.0)]


def slice_files(spark, warehouse):
    """Files of each folder in the current state."""
    out = {}
    for name in warehouse._stored("fact_invoice").inputFiles():
        out.setdefault(name.split("slice=")[1].split("/")[0], set()).add(name)
    return out


def test_only_touched_folders_are_rewritten(spark, warehouse):
    rows = [(c, str(i), 1.0, T1) for c in "ab" for i in range(40)]
    warehouse.upsert("fact_invoice", invoices(spark, *rows))
    before = slice_files(spark, warehouse)
    assert len(before) == 8
    warehouse.upsert("fact_invoice", invoices(spark, ("a", "1", 2.0, T1)))
    after = slice_files(spark, warehouse)
    assert len([b for b in before if before[b] != after[b]]) == 1
    assert warehouse.table("fact_invoice").count() == 80


def test_a_failed_load_leaves_the_old_state(spark, warehouse):
    warehouse.upsert("fact_invoice", invoices(spark, ("a", "1", 1.0, T1)))
    bad = invoices(spark, ("a", "1", 2.0, T1)).withColumn("doc_number", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        warehouse.upsert("fact_invoice", bad)
    assert content(warehouse) == [("a", "1", 1.0)]
    warehouse.upsert("fact_invoice", invoices(spark, ("a", "1", 4.0, T1)))
    assert content(warehouse) == [("a", "1", 4.0)]


@pytest.mark.parametrize("table, match", [
    ("fact_invoice", ["client_id", "invoice_id"]), ("fact_invoice_line", ["client_id", "invoice_id", "line_id"]),
    ("report_rows", ["client_id", "report_table", "start_period", "end_period"])])
def test_the_target_is_not_shuffled(spark, table, match):
    """In the merge and in the search for newer rows, only the batch is exchanged."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    rows = spark.range(3000).select(*(
        F.expr(f"try_cast(CAST(id AS string) AS {dtype})").alias(c) for c, dtype in columns(table) if "<" not in dtype))
    warehouse.replace(table, rows)
    target = warehouse._stored(table).where(F.col("slice").isin([0, 1, 2]))
    batch = materialize(target.limit(100), "batch")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (merging.merge(target, batch, match, bucket_columns(table)),
                   merging.without_stale(target, batch, match, "_version", bucket_columns(table))):
            final = df._jdf.queryExecution().executedPlan().toString()
            scans = re.split(r"\n", final)
            depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in scans]
            at = [i for i, line in enumerate(scans) if "Bucketed: true" in line]
            assert at, final
            for i in at:
                level, above = depth[i], []
                for j in range(i - 1, -1, -1):
                    if depth[j] < level:
                        level = depth[j]
                        above.append(scans[j])
                        if "Join" in scans[j]:
                            break
                assert "Join" in above[-1] and not any("Exchange" in a for a in above), final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_later_session_finds_the_tables(spark, warehouse):
    """The catalog of a session ends with it; folders are registered again."""
    warehouse.upsert("fact_invoice", invoices(spark, *(("a", str(i), 1.0, T1) for i in range(30))))
    spark.sql(f"DROP TABLE {warehouse._name('fact_invoice')}")
    again = Warehouse(spark, warehouse.root)
    assert again.table("fact_invoice").count() == 30
    again.upsert("fact_invoice", invoices(spark, ("a", "3", 5.0, T1), ("b", "x", 1.0, T1)))
    assert again.table("fact_invoice").count() == 31
    assert float(again.table("fact_invoice").where("invoice_id = '3'").first().total_amount) == 5.0


def test_replace(spark, warehouse):
    warehouse.upsert("fact_invoice", invoices(spark, ("a", "1", 1.0, T1)))
    warehouse.replace("fact_invoice", invoices(spark, ("b", "9", 9.0, T1)))
    assert content(warehouse) == [("b", "9", 9.0)]


def test_unpartitioned_table(spark, warehouse):
    days = spark.createDataFrame([(20240101, dt.date(2024, 1, 1))], "date_key int, full_date date")
    warehouse.upsert("dim_date", days)
    warehouse.upsert("dim_date", days.withColumn("date_key", F.lit(20240102)))
    assert warehouse.table("dim_date").count() == 2


def test_keep_last_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(0, 10000, 1, 4).select((F.col("id") % 3).alias("k"), "id")
    last = keep_last(df, ["k"], [F.col("id")])
    assert sorted((r.k, r.id) for r in last.collect()) == [(0, 9999), (1, 9997), (2, 9998)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert keep_last(df, [], [F.col("id")]).count() == 10000


def test_merge_is_null_safe(spark):
    left = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 3)], "k string, v int")
    assert sorted((r.k or "", r.v) for r in merging.merge(left, right, ["k"]).collect()) == [("", 3), ("x", 2)]


def test_key_violations(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "2")], "client_id string, id string")
    assert [tuple(r) for r in key_violations(df, ["client_id", "id"]).collect()] == [("a", "1", 2)]
