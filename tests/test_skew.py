"""Results on data in which one order holds a third of all lines and one customer, part and
supplier a third of the rows: more lines than fit one built record, and many copies of one key."""

import duckdb
import pytest

import __spark_entry__ as contract
from oracle_check import TABLES, compare, connect

SOURCE = "/root/testdata/sf0.001"
HOT = """
CREATE TABLE lineitem AS
SELECT * FROM '{s}/lineitem.parquet'
UNION ALL
SELECT k, p, s, n, q, x, 0.05, 0.02, f, t, d FROM (
  SELECT (SELECT min(o_orderkey) FROM orders) AS k, (SELECT min(p_partkey) FROM part) AS p,
    (SELECT min(s_suppkey) FROM supplier) AS s, CAST(i AS INTEGER) AS n,
    CAST(1 + i % 50 AS DOUBLE) AS q, CAST(1000 + i / 100.0 AS DECIMAL(18,2))::DOUBLE AS x,
    ['A', 'R', 'N'][1 + i % 3] AS f, ['O', 'F'][1 + i % 2] AS t,
    TIMESTAMP '1998-01-01' + INTERVAL (i % 400) DAY AS d
  FROM range(10, 2210) r(i))
UNION ALL
SELECT (SELECT max(o_orderkey) FROM orders), (SELECT min(p_partkey) FROM part),
  (SELECT min(s_suppkey) FROM supplier), 1, 1.0, CAST(i / 100.0 AS DECIMAL(18,2))::DOUBLE,
  0.0, 0.0, 'A', 'O', TIMESTAMP '1998-01-01' FROM range(1, 1500) r(i)
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    for table in TABLES:
        if table not in ("lineitem", "orders"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SOURCE}/{table}.parquet'")
    con.execute(f"""CREATE TABLE orders AS SELECT * REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN (SELECT min(c_custkey) FROM customer)
          ELSE o_custkey END AS o_custkey) FROM '{SOURCE}/orders.parquet'""")
    con.execute(HOT.format(s=SOURCE))
    for table in TABLES:
        con.execute(f"COPY (SELECT * FROM {table}) TO '{target}/{table}.parquet' (FORMAT parquet)")
    return target


@pytest.mark.parametrize("name", [
    "dedup_keep_last", "flatten_invoice_lines", "flatten_bill_lines", "revenue_from_documents",
    "total_revenue", "ap_buckets", "v_top_customers", "v_customer_ranking", "v_reconcile",
])
def test_hot_keys(spark, folder, name):
    compare(contract.queries()[name](spark, folder), connect(folder), contract.oracle_sql()[name])
